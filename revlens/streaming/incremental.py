"""Incremental processing (T-1, T-2, S9, K8, J5, U4).

Batch form: a left-anti join against a manifest of processed inputs and a
back-fill union.  Streaming form: a file-source stream with
``trigger(availableNow=True)`` whose checkpoint remembers processed files, so
a re-run handles only new files and then stops; results go through
``foreachBatch`` to one folder per batch, so a batch that is replayed after a
failure replaces itself.  Checkpoints live under the shared
``spark.checkpoint.dir`` (see ``revlens.session.checkpoint_dir``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir


def new_inputs(candidates: DataFrame, processed: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Candidates whose key is not in the processed manifest."""
    return candidates.join(processed, key if isinstance(key, list) else [key], "left_anti")


def backfill(previous: DataFrame, fresh: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Earlier outputs for inputs *not* processed in this run, plus this
    run's outputs (an input processed now never appears twice)."""
    k = key if isinstance(key, list) else [key]
    old = previous.join(fresh.select(*k).distinct(), k, "left_anti")
    return old.withColumn("origin", F.lit("backfill")).unionByName(fresh.withColumn("origin", F.lit("new")))


def run_available_now(spark: SparkSession, source_dir: str, schema: T.StructType,
                      transform: Callable[[DataFrame], DataFrame], sink_path: str, name: str,
                      fmt: str = "parquet", source_format: str = "parquet") -> None:
    """T-1: process every file not yet seen by this query's checkpoint, write the
    transformed rows to ``sink_path`` (column ``batch``: the batch they came in),
    stop when caught up."""
    ck = f"{checkpoint_dir(spark)}/streams/{name}"
    stream = spark.readStream.schema(schema).format(source_format).load(source_dir)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        transform(batch).write.mode("overwrite").format(fmt).save(f"{sink_path}/batch={epoch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; un-zoned Parquet timestamps are read as
    TIMESTAMP_NTZ and are re-typed in the session time zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def dedupe_within_watermark(stream: DataFrame, key: Sequence[str], ts: str,
                            delay: str = "1 day") -> DataFrame:
    """De-duplication of a stream by key where copies come at most ``delay`` apart;
    state is bounded by the watermark.  A resume that must know every earlier
    row is ``run_new_rows``."""
    return _event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def first_of_keys(stream: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """T-2: the first row of every key of a stream, for good.

    Keyed state holds one mark per key without expiry (RocksDB state store: on disk, saved
    as changes), so a batch costs what it holds and not what came before.  The kept row
    is that of the first batch with the key, in it the smallest by ``order`` (nulls
    first), which should be a total order.  Null keys are a key like any other."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    columns, order = stream.columns, list(order)

    class First(StatefulProcessor):
        def init(self, handle) -> None:
            self.seen = handle.getValueState("seen", "seen boolean")

        def handleInputRows(self, key, rows, timerValues):
            if self.seen.exists():
                return
            best = None
            for part in rows:                        # one chunk of a hot key at a time
                part = part if best is None else pd.concat([best, part])
                best = part.sort_values(order, kind="stable", na_position="first").head(1)
            self.seen.update((True,))
            yield best[columns]

        def close(self) -> None:
            pass

    return stream.groupBy(*key).transformWithStateInPandas(
        statefulProcessor=First(), outputStructType=stream.schema, outputMode="Append", timeMode="None")


def run_new_rows(spark: SparkSession, source_dir: str, schema: T.StructType, key: Sequence[str],
                 sink_path: str, name: str, source_format: str = "parquet", order: Sequence[str] = ()) -> None:
    """T-2: resume.  Rows whose key no earlier batch had, one of each key (see ``first_of_keys``;
    ``order`` defaults to all columns), however long ago that batch was.  Keys are kept as
    state under the shared checkpoint folder and earlier batches are not read; a batch
    that is replayed after a failure starts from the state before it and replaces its folder."""
    ck = f"{checkpoint_dir(spark)}/streams/{name}"
    stream = spark.readStream.schema(schema).format(source_format).load(source_dir)
    first = first_of_keys(stream, list(key), list(order) or schema.names)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path}/batch={epoch_id}")

    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)                 # read when the query starts
    try:
        q = (first.writeStream.foreachBatch(write_batch).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
    q.awaitTermination()


def windowed_rate(stream: DataFrame, ts: str, flag, window: str = "1 day", delay: str = "1 day",
                  keys: Sequence[str] = ()) -> DataFrame:
    """Tumbling-window count and flagged share (e.g. negative-review rate),
    usable on a stream (with watermark, append mode) or a batch DataFrame."""
    return (_event_time(stream, ts).withWatermark(ts, delay)
            .groupBy(F.window(ts, window).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("flagged"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                    "n", "flagged", (F.col("flagged") / F.col("n")).alias("rate")))


def run_running_totals(spark: SparkSession, source_dir: str, schema: T.StructType, keys: Sequence[str],
                       sink_path: str, name: str, source_format: str = "parquet") -> None:
    """T-2 'continue totals': a stateful streaming count per key.  The state
    store (under the shared checkpoint folder) carries the totals across runs,
    so a resumed run only reads new files and the sink always holds the full,
    current totals (complete mode, rewritten per micro-batch)."""
    ck = f"{checkpoint_dir(spark)}/streams/{name}"
    stream = spark.readStream.schema(schema).format(source_format).load(source_dir)
    totals = stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    q = (totals.writeStream.outputMode("complete").foreachBatch(write_batch)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()

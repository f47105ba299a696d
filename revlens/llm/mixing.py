"""Mixing sources to target weights with hash-threshold histograms.

Only DataFrame functions.  Every row has a 36-bit hash; a source takes the rows
below a threshold.  The threshold comes from three nested histograms of 4,096
buckets: words by (source, bucket), then only inside the bucket on the boundary,
twice.  No source is sorted and no row leaves its task before the final filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import WORD, stage

BITS, LEVELS = 12, 3


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def row_hash(key: Column, text: Column) -> Column:
    """36 bits of the md5 of id and text: equal on every run and engine."""
    whole = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
                  .cast("binary"))
    return F.conv(F.substring(whole, 1, 9), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """(source, source_size, target): shares by weight, filled up to ``limit`` times
    a source's size, the excess dealt to the others by weight.

    One row per source.  In order of ``limit * size / weight`` the sources that stop
    at their limit come first, so one running sum finds the common level.
    """
    n = len(weights)
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn % n + 1).cast("int"))
    cap = limit * F.col("source_size").cast("double")
    everything = Window.partitionBy()
    rising = Window.orderBy("_rho", "_w", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    t = (sizes.withColumn("_w", w).withColumn("_cap", cap).withColumn("_rho", F.col("_cap") / F.col("_w"))
         .withColumn("_all", F.sum("source_size").over(everything).cast("double"))
         .withColumn("_weights", F.sum("_w").over(everything))
         .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / (F.col("_weights") - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
         .withColumn("_full", F.col("_rho") <= F.col("_level"))
         .withColumn("_open", F.min(F.when(~F.col("_full"), F.struct("_rho", "_w", "_level"))).over(everything)))
    return t.select("source", "source_size",
                    F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * F.col("_open._level")).alias("target"))


def sized_rows(docs: DataFrame, key: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(F.col(key).alias("k"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                       row_hash(F.col(key), F.col(text)).alias("h"), *more)


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """(s, source_size, target, base, threshold), a row per source, from rows
    (source, size, h): every row of source s is taken ``base`` times, and once more if
    its hash is below the threshold."""
    sizes = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (source_targets(sizes, weights, limit).withColumn("base", whole.cast("long"))
            .withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
            .withColumn("prefix", F.lit(0).cast("long")))
    plan = stage(plan, "mix-plan0")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        # all rows at the first level, later only those in the boundary bucket
        held = plan.select(F.col("source").alias("s"), "prefix", "rest")
        near = sized.join(held, sized["source"].eqNullSafe(held["s"])
                          & (F.shiftright("h", shift + BITS) == F.col("prefix")))
        histogram = (near.groupBy("source", F.shiftright("h", shift).alias("bucket"))
                     .agg(F.sum("size").alias("words"), F.first("rest").alias("rest")))
        up = Window.partitionBy("source").orderBy("bucket")
        # the boundary is the first bucket that reaches the rest of the budget
        cut = (histogram.withColumn("above", F.sum("words").over(up)).withColumn("below", F.col("above") - F.col("words"))
               .filter(F.col("above") > F.col("rest")).groupBy("source")
               .agg(F.min(F.struct("bucket", "below", "words")).alias("cut")).withColumnRenamed("source", "s"))
        missed = F.lit(1).cast("long") + F.shiftleft(F.col("prefix"), BITS) + ((1 << BITS) - 1)
        plan = stage(plan.join(cut, plan["source"].eqNullSafe(cut["s"]), "left")
                     .select("source", "source_size", "target", "base",
                             (F.col("rest") - F.coalesce("cut.below", F.lit(0))).alias("rest"),
                             F.coalesce("cut.bucket", missed).alias("prefix"),
                             F.coalesce("cut.words", F.lit(0)).alias("words")), f"mix-plan{level}")
    # rows below the threshold, and the boundary row itself if that comes nearer
    threshold = F.col("prefix") + F.when(2 * F.col("rest") >= F.col("words"), 1).otherwise(0)
    return plan.select(F.col("source").alias("s"), "source_size", "target", "base", threshold.alias("threshold"))


def with_repeats(sized: DataFrame, plan: DataFrame, limit: int = 3) -> DataFrame:
    """Rows of ``sized`` with source_size, target and ``repeats``.  The plan has a row
    per source: Spark broadcasts it while it is small and joins it otherwise."""
    n = F.least(F.col("base") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0), F.lit(limit))
    return (sized.join(plan, sized["source"].eqNullSafe(plan["s"]))
            .withColumn("repeats", F.when(F.col("size") > 0, n).otherwise(F.lit(0)).cast("int")))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """(key, size, source_size, target, repeats, taken) per row of ``docs``.

    Sources by code point, null last, weigh ``weights`` in turn.  ``repeats`` (0 to
    ``limit``) is how often a document goes into the mix: every document of a source
    the whole part of target / source_size, those below the threshold once more.
    On the boundary the nearer side is taken.  Null text has size 0.  Rows equal in
    id and text are taken or left together.  An empty table gives an empty table.
    """
    sized = stage(sized_rows(docs, key, text, source), "mix-sized")
    plan = stage(thresholds(sized, weights, limit), "mix-plan")
    return (with_repeats(sized, plan, limit)
            .select(F.col("k").alias(key), "size", "source_size", "target", "repeats",
                    (F.col("size") * F.col("repeats")).alias("taken")))


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they were."""
    sized = stage(sized_rows(docs, key, text, source), "mix-sized")
    plan = stage(thresholds(sized, weights, limit), "mix-plan")
    rows = with_repeats(sized_rows(docs, key, text, source, F.struct("*").alias("row")), plan, limit)
    return (rows.filter("repeats > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
            .select("row.*"))

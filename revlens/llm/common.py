"""Helpers shared by the operators: staged tables, folds, tiles, local forests."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import checkpoint_dir

#: A word is a maximal run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    plan, and the reader knows the real size of the table.  Every call takes a
    new folder, so repeated runs never meet.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(key: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def task_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Forest:
    """Union of the members of two tiles; keeps one label per member.

    ``edges`` are the links of a spanning forest: at most one per member however
    many pairs were linked, so a group of n copies costs n rows and not n^2.
    """

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.linked = np.zeros(n, dtype=bool)

    def join(self, i: int, others: np.ndarray) -> None:
        lab = self.label
        self.linked[i] = True
        self.linked[others] = True
        found = np.unique(np.append(lab[others], lab[i]))
        if len(found) > 1:
            lab[np.isin(lab, found[1:])] = found[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.linked & (self.label != np.arange(len(self.label))))
        return at, self.label[at]


def half_ball(radius: int) -> list[tuple[int, int]]:
    """Offsets in two dimensions within L1 distance ``radius``, one of each +/- pair."""
    return [(a, b) for a in range(radius + 1) for b in range(-radius, radius + 1)
            if a + abs(b) <= radius and (a > 0 or b >= 0)]


def half_box() -> list[tuple[int, int]]:
    """Own cell and neighbours of a two-dimensional grid, one of each +/- pair."""
    return [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]


def tile_pairs(items: DataFrame, cell: tuple[str, str], member: Column, payload: list[str],
               offsets: list[tuple[int, int]], capacity: int, name: str,
               extra_key: str | None = None) -> DataFrame:
    """Rows (a, b, same): the members of two tiles that may hold linked rows.

    ``items`` are grouped by a two-number ``cell``.  A cell with more than
    ``capacity`` rows is dealt over several tiles by the hash of ``member``, so
    that no tile grows with the data; all pairs of tiles whose cells differ by one
    of ``offsets`` are returned, each once, spread evenly over the tasks.
    ``payload`` columns travel as an array of structs.
    """
    keys = [*cell, *([extra_key] if extra_key else [])]
    cells = stage(items.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), f"{name}-cells")
    tiles = stage(
        items.join(cells, keys)
        .withColumn("_chunk", F.pmod(F.xxhash64(member), F.ceil(F.col("_n") / capacity)).cast("int"))
        .groupBy(*keys, "_chunk").agg(F.collect_list(F.struct(*payload)).alias("rows"))
        .withColumn("tile", F.concat_ws(":", *keys, "_chunk")), f"{name}-tiles")
    near = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in offsets])
    meta = tiles.select(*keys, "tile")
    left = (meta.withColumn("_o", F.explode(near))
            .select((F.col(cell[0]) + F.col("_o.a")).alias(cell[0]),
                    (F.col(cell[1]) + F.col("_o.b")).alias(cell[1]),
                    *([extra_key] if extra_key else []), F.col("tile").alias("tile_a"),
                    ((F.col("_o.a") == 0) & (F.col("_o.b") == 0)).alias("_home")))
    pairs = (left.join(meta.withColumnRenamed("tile", "tile_b"), keys)
             .filter(~F.col("_home") | (F.col("tile_a") <= F.col("tile_b")))
             .select("tile_a", "tile_b"))
    body = tiles.select("tile", "rows")
    return (pairs
            .join(body.toDF("tile_a", "a"), "tile_a")
            .join(body.toDF("tile_b", "b"), "tile_b")
            .withColumn("same", F.col("tile_a") == F.col("tile_b"))
            .repartition(task_partitions(items.sparkSession), "tile_a", "tile_b")
            .select("a", "b", "same"))

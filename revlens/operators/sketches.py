"""Stored sketches that merge with the next run's (A10, A12 across runs).

* Distinct counts: HyperLogLog sketches (Spark's own), a binary value per key.
* Quantiles: counts per logarithmic bucket, a small table per key.  Bucket i holds the
  values in (g^(i-1), g^i], g = (1 + a) / (1 - a), so a quantile is within a relative
  error of a.  Merging adds counts: the result is that of one pass, whatever the split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LG_K = 14


def distinct_sketch(df: DataFrame, value: str, keys: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(keys..., sketch): relative error about 1.04 / sqrt(2^lg_k); nulls do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), lg_k).alias("sketch"))


def merge_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of several runs to one per key; the union of the values they saw."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimate(sketches: DataFrame, keys: Sequence[str], name: str = "distinct_cnt") -> DataFrame:
    return sketches.select(*keys, F.hll_sketch_estimate("sketch").alias(name))


def value_buckets(df: DataFrame, value: str, keys: Sequence[str] = (), accuracy: float = 0.01) -> DataFrame:
    """(keys..., sign, bucket, cnt): the rows of each logarithmic bucket.  Nulls and values that
    are not finite are left out; zero is sign 0, bucket 0."""
    v = F.col(value).cast("double")
    width = math.log((1 + accuracy) / (1 - accuracy))
    size = F.abs(v)
    # a value on an edge (up to rounding) belongs below it
    bucket = F.when(size > 0, F.ceil(F.log(size) / width - 1e-9)).otherwise(F.lit(0)).cast("int")
    return (df.where(v.isNotNull() & ~F.isnan(v) & (size < float("inf")))
            .groupBy(*keys, F.signum(v).cast("int").alias("sign"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def merge_buckets(buckets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return buckets.groupBy(*keys, "sign", "bucket").agg(F.sum("cnt").alias("cnt"))


def bucket_quantiles(buckets: DataFrame, probs: Sequence[float], keys: Sequence[str] = (),
                     accuracy: float = 0.01) -> DataFrame:
    """(keys..., count, p..): the value at rank floor(p * (n - 1)), within ``accuracy`` of it.

    A key has at most a few thousand buckets, whatever its rows: the window holds those."""
    gamma = (1 + accuracy) / (1 - accuracy)
    middle = F.col("sign") * F.pow(F.lit(gamma), F.col("bucket").cast("double")) * (2 / (gamma + 1))
    place = Window.partitionBy(*keys).orderBy("sign", F.col("sign") * F.col("bucket"))
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    ranked = (buckets.withColumn("_upto", F.sum("cnt").over(upto))
              .withColumn("_n", F.sum("cnt").over(Window.partitionBy(*keys))).withColumn("_v", middle))
    aggs = [F.max("_n").alias("count")]
    for p in probs:
        rank = F.floor(F.lit(float(p)) * (F.col("_n") - 1))
        here = (F.col("_upto") > rank) & (F.col("_upto") - F.col("cnt") <= rank)
        aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"p{int(round(p * 100))}"))
    return ranked.groupBy(*keys).agg(*aggs) if keys else ranked.agg(*aggs)

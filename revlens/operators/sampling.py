"""Ordered sampling rules from the collection step.

* ``stratified_quota``: per stratum keep the first max(target, floor(share*n)).
* ``cumulative_cap``: take items in order while the running total before the
  item is below the cap.
* ``first_seen_distinct``: order-preserving distinct = min position per value.

Both ordered rules need a position inside a group.  A plain window would put a
whole group in one task, and one group may hold a third of the data, so the
groups larger than ``min_split`` rows are split: cut points per such group come
from ``percentile_approx`` on the leading order column, rows go to the bucket of their order value (buckets are
monotone in the order), per-bucket counts/sums give exact offsets, and the
window then runs per (group, bucket) only.  Buckets that lie entirely past the
quota / cap are dropped before any sorting.  Results are exact: the cut
points only decide how the work is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P


def _sizes(df: DataFrame, group: Sequence[str], lead: str, buckets: int, min_split: int) -> DataFrame:
    """(group..., _n, _cuts): size of each group and, above ``min_split`` rows, its cut points, in one aggregate."""
    probs = [i / buckets for i in range(1, buckets)]
    return (df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(lead, probs, 1000).alias("_c"))
              .select(*group, "_n", F.when(F.col("_n") > min_split, F.col("_c")).alias("_cuts")))


def _bucketed(df: DataFrame, group: Sequence[str], lead: str, sizes: DataFrame) -> DataFrame:
    """Add ``_b``: bucket of each row inside its group, monotone in ``lead``.
    Only groups with cut points are split; every other group is bucket 0."""
    cuts = sizes.where(F.col("_cuts").isNotNull()).select(*group, "_cuts")
    j = df.join(cuts, list(group), "left")     # one row per big group: AQE broadcasts it when small
    b = F.coalesce(F.size(F.filter(F.array_distinct("_cuts"), lambda c: c < F.col(lead))), F.lit(0))
    return j.withColumn("_b", b).drop("_cuts")


def stratified_quota(df: DataFrame, strata: Sequence[str], order: Sequence[Column | str],
                     target: int = P.STAR_QUOTA_TARGET, share: float = P.STAR_QUOTA_SHARE,
                     buckets: int = 32, min_split: int = 100_000) -> DataFrame:
    """Keep the first ``greatest(target, floor(share * n))`` rows of each stratum
    (``seq`` = 1-based position within the stratum, W7).  ``order`` lists
    ascending columns forming a total order."""
    strata, order = list(strata), list(order)
    quota = F.greatest(F.lit(target), F.floor(F.lit(share) * F.col("_n")).cast("bigint"))
    if buckets <= 1:
        w = Window.partitionBy(*strata).orderBy(*order)
        counts = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
        return (df.join(counts.select(*strata, quota.alias("_q")), strata)
                  .withColumn("seq", F.row_number().over(w))
                  .where(F.col("seq") <= F.col("_q")).drop("_q"))
    sizes = _sizes(df, strata, order[0], buckets, min_split)
    bd = _bucketed(df, strata, order[0], sizes)
    per_b = bd.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = (per_b.withColumn("_off", F.coalesce(F.sum("_bn").over(wb), F.lit(0)))
                 .join(sizes.select(*strata, quota.alias("_q")), strata)
                 .where(F.col("_off") < F.col("_q"))            # buckets past the quota never sort
                 .select(*strata, "_b", "_off", "_q"))
    w = Window.partitionBy(*strata, "_b").orderBy(*order)
    return (bd.join(offs, [*strata, "_b"])
              .withColumn("seq", F.col("_off") + F.row_number().over(w))
              .where(F.col("seq") <= F.col("_q")).drop("_b", "_off", "_q"))


def cumulative_cap(items: DataFrame, group: Sequence[str], order: Sequence[str], value: str,
                   cap: int = P.CATEGORY_REVIEW_CAP, buckets: int = 32, min_split: int = 100_000) -> DataFrame:
    """Take items in order while the running total *before* the item is below
    ``cap`` (the item that crosses the cap is kept); ``running_before`` is kept."""
    group, order = list(group), list(order)
    if buckets <= 1:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum(value).over(w), F.lit(0))
        return items.withColumn("running_before", before).where(F.col("running_before") < cap)
    bd = _bucketed(items, group, order[0], _sizes(items, group, order[0], buckets, min_split))
    per_b = bd.groupBy(*group, "_b").agg(F.sum(value).alias("_bs"))
    wb = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = (per_b.withColumn("_off", F.coalesce(F.sum("_bs").over(wb), F.lit(0)))
                 .where(F.col("_off") < cap).select(*group, "_b", "_off"))
    w = Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_off") + F.coalesce(F.sum(value).over(w), F.lit(0))
    return (bd.join(offs, [*group, "_b"]).withColumn("running_before", before)
              .where(F.col("running_before") < cap).drop("_b", "_off"))


def first_seen_distinct(df: DataFrame, value: str, order: Sequence[str], limit: int | None = None) -> DataFrame:
    """Distinct values with the position where each was first seen (an
    aggregate); ``limit`` keeps the first n in that order (a top-k report)."""
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    out = df.groupBy(value).agg(first).select(value, *[F.col(f"_first.{c}").alias(c) for c in order])
    return out.orderBy(*order, value).limit(limit) if limit is not None else out

"""Relations between review properties: keyword against volume, image against helpfulness.

Both work on small aggregates that add up over inputs (counts and sums per key and
month, moments per stratum); rows are read once and combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOMENTS = ["n", "total", "squares"]


def keyword_months(reviews: DataFrame, keyword: Column, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., month, n, hits): reviews and reviews with the keyword, every month from a key's
    first to its last (0 where there is none)."""
    keys = list(keys)
    per = (reviews.where(F.col(date).isNotNull()).groupBy(*keys, F.trunc(date, "month").alias("month"))
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(keyword).alias("hits")))
    span = per.groupBy(*keys).agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    spine = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("month"))
    held = per.toDF(*[f"_{k}" for k in keys], "_month", "n", "hits")
    on = [F.col("month") == F.col("_month"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]]
    return spine.join(held, on, "left").select(*keys, "month", F.coalesce("n", F.lit(0)).alias("n"),
                                               F.coalesce("hits", F.lit(0)).alias("hits"))


def lagged_keyword_volume(reviews: DataFrame, keyword: Column, date: str, keys: Sequence[str] = (),
                          lags: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """(keys..., lag, months, r): correlation of a month's share of reviews with the keyword and the
    number of reviews ``lag`` months later.

    A month without reviews has no share and makes no pair, but counts as 0 reviews for
    earlier months.  ``r`` is null for fewer than two pairs and without variation.  The
    window holds the months of one key."""
    keys = list(keys)
    months = keyword_months(reviews, keyword, date, keys)
    order = Window.partitionBy(*keys).orderBy("month")
    later = F.array(*[F.struct(F.lit(lag).alias("lag"), F.lead("n", lag).over(order).alias("n")) for lag in lags])
    pairs = (months.withColumn("_later", later)
             .select(*keys, (F.col("hits") / F.when(F.col("n") > 0, F.col("n"))).alias("share"), F.explode("_later").alias("l"))
             .where(F.col("share").isNotNull() & F.col("l.n").isNotNull()))
    x, y = F.col("share"), F.col("l.n").cast("double")
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return pairs.groupBy(*keys, F.col("l.lag").alias("lag")).agg(
        F.count(F.lit(1)).alias("months"), r.alias("r"))


def effect_moments(reviews: DataFrame, treated: str, value: str, strata: Sequence[str]) -> DataFrame:
    """(strata..., treated, n, total, squares): moments of ``value``; they add up over inputs
    (``merge_moments``).  Rows without a value or a treatment are left out."""
    v = F.col(value).cast("double")
    return (reviews.where(v.isNotNull() & F.col(treated).isNotNull()).groupBy(*strata, F.col(treated).alias("treated"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares")))


def merge_moments(moments: DataFrame, strata: Sequence[str]) -> DataFrame:
    return moments.groupBy(*strata, "treated").agg(*[F.sum(c).alias(c) for c in MOMENTS])


def stratified_effect(moments: DataFrame, strata: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., strata, n_treated, n_other, effect, std_error): difference of the means of treated and
    other rows within strata, weighted by n1 * n0 / (n1 + n0).

    ``by`` (some of ``strata``) gives a result for each of its values.  A stratum counts if
    both sides have two rows or more; without one the effect is null."""
    def side(flag: bool) -> list[Column]:
        of = F.col("treated") == F.lit(flag)
        return [F.sum(F.when(of, F.col(c))).alias(f"{c}{int(flag)}") for c in MOMENTS]

    s = moments.groupBy(*strata).agg(*side(True), *side(False))
    usable = s.where((F.col("n1") >= 2) & (F.col("n0") >= 2))
    variance = [(F.col(f"squares{i}") - F.col(f"total{i}") * F.col(f"total{i}") / F.col(f"n{i}")) / (F.col(f"n{i}") - 1)
                / F.col(f"n{i}") for i in (1, 0)]
    weight = F.col("n1") * F.col("n0") / (F.col("n1") + F.col("n0"))
    difference = F.col("total1") / F.col("n1") - F.col("total0") / F.col("n0")
    per = usable.select(*by, "n1", "n0", weight.alias("w"), difference.alias("d"),
                        F.greatest(variance[0] + variance[1], F.lit(0.0)).alias("v"))
    total = F.sum("w")
    aggs = [F.count(F.lit(1)).alias("strata"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n_treated"),
            F.coalesce(F.sum("n0"), F.lit(0)).alias("n_other"), (F.sum(F.col("w") * F.col("d")) / total).alias("effect"),
            (F.sqrt(F.sum(F.col("w") * F.col("w") * F.col("v"))) / total).alias("std_error")]
    return per.groupBy(*by).agg(*aggs) if by else per.agg(*aggs)

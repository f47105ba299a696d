"""Descriptive statistics, distributions, time series, correlations.

Scale notes
* Exact quantiles never gather rows: values are first counted per distinct
  value (a distributed aggregate, combined map-side), and only that histogram
  is ordered to locate the ranks.  Its size is bounded by the value domain
  (review counts, text lengths, helpful counts), not by the row count.
* Histograms assign the bin with a CASE ladder on the data side and join the
  tiny bin dimension afterwards (empty bins kept, no range join).
* Month spines are generated per key from that key's min/max month with
  ``sequence`` — no collect, no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.parse import bin_label, safe_int


# ----------------------------------------------------------------- quantiles
#: Ranges into which the values of a table without keys are cut to rank them.
RANGES = 64


def _hist(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Per-key value histogram with cumulative positions, total and mean.

    The histogram is a distributed, map-side-combined aggregate; the windows
    then run over distinct values per key (bounded by the value domain), and
    without keys per range of values."""
    v = F.col(value).cast("double")
    hist = df.where(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    if not keys:
        return _ranked_ranges(hist)
    w_all = Window.partitionBy(*keys)
    w_ord = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return (hist.withColumn("_n", F.sum("_c").over(w_all))
                .withColumn("_mean", F.sum(F.col("_c") * F.col("_v")).over(w_all) / F.col("_n"))
                .withColumn("_cum", F.sum("_c").over(w_ord))
                .withColumn("_start", F.col("_cum") - F.col("_c")))


def _ranked_ranges(hist: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Cumulative positions of a whole table's histogram without one task that sees it all.

    Cut points (a quantile sketch of the distinct values) deal the values to ranges;
    the counts per range, ``ranges`` numbers, give each range its first position,
    and inside a range a window adds up.  The cut points only decide how the work is
    dealt, so the positions are exact."""
    probs = [i / ranges for i in range(1, ranges)]
    whole = hist.agg(F.struct(F.array_distinct(F.percentile_approx("_v", probs, 1000)).alias("cuts"),
                              F.sum("_c").alias("n"), F.sum(F.col("_c") * F.col("_v")).alias("total"))).scalar()
    ranged = hist.withColumn("_w", whole) \
        .withColumn("_r", F.coalesce(F.size(F.filter("_w.cuts", lambda c: c < F.col("_v"))), F.lit(0)))
    counts = ranged.groupBy("_r").agg(F.sum("_c").alias("_c")) \
        .agg(F.collect_list(F.struct("_r", "_c"))).scalar()                     # at most ``ranges`` entries
    before = F.aggregate(F.filter(F.col("_counts"), lambda e: e["_r"] < F.col("_r")), F.lit(0).cast("bigint"),
                         lambda total, e: total + e["_c"])
    w_ord = Window.partitionBy("_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.withColumn("_counts", counts).withColumn("_cum", before + F.sum("_c").over(w_ord))
                  .select("_v", "_c", F.col("_w.n").alias("_n"), (F.col("_w.total") / F.col("_w.n")).alias("_mean"),
                          "_cum", (F.col("_cum") - F.col("_c")).alias("_start")))


def _quantile_aggs(probs: Sequence[float], names: Sequence[str]) -> list[Column]:
    """Linear interpolation between the order statistics around p*(n-1)."""
    out = []
    for p, name in zip(probs, names):
        pos = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        at_lo = F.max(F.when((F.col("_start") <= lo) & (lo < F.col("_cum")), F.col("_v")))
        at_hi = F.max(F.when((F.col("_start") <= hi) & (hi < F.col("_cum")), F.col("_v")))
        out.append((at_lo + F.max(pos - lo) * (at_hi - at_lo)).alias(name))
    return out


def _names(probs: Sequence[float]) -> list[str]:
    return [f"p{int(round(p * 100))}" for p in probs]


def _agg(h: DataFrame, keys: Sequence[str], aggs: list[Column]) -> DataFrame:
    return h.groupBy(*keys).agg(*aggs) if keys else h.agg(*aggs)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont``) per key,
    from the value histogram — rows are never gathered."""
    keys = list(keys)
    return _agg(_hist(df, value, keys), keys, _quantile_aggs(probs, list(names or _names(probs))))


def describe(df: DataFrame, value: str, probs: Sequence[float] = (0.5, 0.75, 0.9, 0.95, 0.99),
             keys: Sequence[str] = (), exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """count, mean, std (sample, two-pass), min, quantiles, max — pandas
    ``describe`` — in one aggregate over the per-key value histogram.

    Without keys the distinct values are ranked by ranges, so any measure is exact at any
    size.  With keys one task ranks the distinct values of a key (counts,
    lengths); for a continuous measure with mostly distinct values use
    ``exact=False``: mergeable quantile sketches (``percentile_approx``),
    combined map-side, so no task ever sees more than its own rows."""
    keys = list(keys)
    if not exact:
        v = F.col(value).cast("double")
        aggs = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                *[F.percentile_approx(v, float(p), accuracy).cast("double").alias(n)
                  for p, n in zip(probs, _names(probs))],
                F.max(v).alias("max")]
        return _agg(df, keys, aggs)
    h = _hist(df, value, keys)
    n = F.first("_n")
    aggs = [n.cast("bigint").alias("count"), F.first("_mean").alias("mean"),
            F.sqrt(F.sum(F.col("_c") * (F.col("_v") - F.col("_mean")) ** 2) / F.when(n > 1, n - 1)).alias("std"),
            F.min("_v").alias("min"), *_quantile_aggs(probs, _names(probs)), F.max("_v").alias("max")]
    return _agg(h, keys, aggs)


# ----------------------------------------------------------------- product metadata stats
def identified(meta: DataFrame) -> DataFrame:
    """Products with an id; the others are in no table, only in the counters."""
    return meta.where(F.coalesce(F.trim(F.col("product_id").cast("string")) != "", F.lit(False)))


def valid_distribution(meta: DataFrame, dist: str = "rating_distribution",
                       valid_scores: Sequence[int] = P.VALID_SCORES) -> DataFrame:
    """Rating maps unpivoted to (.., score, cnt) keeping only valid score keys."""
    ex = meta.select("*", F.explode(dist).alias("_k", "_v"))
    return (ex.select(*[c for c in meta.columns if c != dist],
                      safe_int("_k").cast("int").alias("score"),
                      F.coalesce(safe_int("_v"), F.lit(0)).alias("cnt"))
              .where(F.col("score").isin(list(valid_scores))))


def product_review_counts(meta: DataFrame, dist: str = "rating_distribution",
                          valid_scores: Sequence[int] = P.VALID_SCORES) -> DataFrame:
    """Declared total, else sum of valid distribution counts, else 0; summed per id."""
    vs = list(valid_scores)
    d = F.col(dist)
    valid_sum = F.aggregate(
        F.map_entries(F.map_filter(F.coalesce(d, F.create_map().cast("map<string,string>")),
                               lambda k, v: safe_int(k).isin(vs))),
        F.lit(0).cast("bigint"), lambda acc, e: acc + F.coalesce(safe_int(e["value"]), F.lit(0)))
    has_dist = d.isNotNull() & (F.size(d) > 0)
    total = safe_int("total_reviews")
    n = F.coalesce(total, F.when(has_dist, valid_sum), F.lit(0))
    return identified(meta).groupBy("product_id").agg(F.sum(n).cast("bigint").alias("review_cnt"))


def category_product_counts(meta: DataFrame) -> DataFrame:
    """A10: distinct products per category (exact; ``approx_count_distinct`` at will)."""
    return identified(meta).groupBy("category").agg(F.countDistinct("product_id").alias("product_cnt"))


def review_count_bins(counts: DataFrame, spark: SparkSession, value: str = "review_cnt",
                      bins: Sequence[int] = P.REVIEW_COUNT_BINS) -> DataFrame:
    """Left-closed bins, last open; empty bins kept, values below the first edge dropped."""
    bins = list(bins)
    rows = [(i, bins[i], bins[i + 1] if i + 1 < len(bins) else None) for i in range(len(bins))]
    dim = spark.createDataFrame(rows, "bin_order int, lo long, hi long") \
        .withColumn("bin", bin_label(F.col("lo"), F.col("hi")))
    v = F.col(value)
    ladder = None
    for i, lo, hi in rows:
        cond = (v >= lo) if hi is None else ((v >= lo) & (v < hi))
        ladder = F.when(cond, F.lit(i)) if ladder is None else ladder.when(cond, F.lit(i))
    per_bin = counts.select(ladder.alias("bin_order")).where(F.col("bin_order").isNotNull()) \
        .groupBy("bin_order").agg(F.count(F.lit(1)).alias("product_cnt"))
    return (F.broadcast(dim).join(per_bin, "bin_order", "left")   # dim: len(bins) rows
              .select("bin", "bin_order", F.coalesce("product_cnt", F.lit(0)).alias("product_cnt")))


def score_distribution(meta: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per (by..., score) summed from rating maps, valid scores only."""
    d = valid_distribution(identified(meta))
    return d.groupBy(*by, "score").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def category_score_summary(meta: DataFrame) -> DataFrame:
    """total_cnt, score_sum, mean_score per category."""
    d = score_distribution(meta, ["category"])
    return (d.groupBy("category")
             .agg(F.sum("cnt").cast("bigint").alias("total_cnt"),
                  F.sum(F.col("score") * F.col("cnt")).cast("bigint").alias("score_sum"))
             .withColumn("mean_score", F.try_divide(F.col("score_sum").cast("double"), F.col("total_cnt"))))


def data_quality_counters(meta: DataFrame, dist: str = "rating_distribution",
                          valid_scores: Sequence[int] = P.VALID_SCORES) -> DataFrame:
    """One row of counters in a single pass."""
    vs = list(valid_scores)
    d = F.col(dist)
    has_id = F.col("product_id").isNotNull() & (F.trim(F.col("product_id").cast("string")) != "")
    has_dist = d.isNotNull() & (F.size(d) > 0)
    keys = F.map_keys(F.coalesce(d, F.create_map().cast("map<string,string>")))
    n_invalid = F.size(F.filter(keys, lambda k: ~F.coalesce(safe_int(k).isin(vs), F.lit(False))))
    valid_sum = F.aggregate(F.map_entries(F.map_filter(F.coalesce(d, F.create_map().cast("map<string,string>")),
                                                   lambda k, v: safe_int(k).isin(vs))),
                            F.lit(0).cast("bigint"),
                            lambda acc, e: acc + F.coalesce(safe_int(e["value"]), F.lit(0)))
    total = safe_int("total_reviews")
    n = F.coalesce(total, F.when(has_dist, valid_sum), F.lit(0))
    return meta.agg(
        F.count_if(~has_id).alias("missing_product_id"),
        F.sum(F.when(has_id, n_invalid).otherwise(0)).cast("bigint").alias("invalid_score"),
        F.count_if(has_id & ~has_dist).alias("missing_rating_distribution"),
        F.count_if(has_id & has_dist & total.isNotNull() & (total != valid_sum)).alias("review_cnt_mismatch"),
        F.count_if(has_id).alias("total_products_seen"),
        F.sum(F.when(has_id, n).otherwise(0)).cast("bigint").alias("total_reviews_collected"),
    )


# ----------------------------------------------------------------- review-level EDA
def product_metrics(reviews: DataFrame, key: str = "product_id", score: str = "score",
                    helpful: str = "helpful_count") -> DataFrame:
    """Mean score, mean helpful (NULL->0), number of scored reviews."""
    return reviews.groupBy(key).agg(
        F.avg(score).alias("mean_score"),
        F.avg(F.coalesce(F.col(helpful).cast("int"), F.lit(0))).alias("mean_helpful"),
        F.count(score).alias("review_cnt"))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Top-k report: distributed TakeOrderedAndProject, then rank the k rows."""
    return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def value_share(reviews: DataFrame, value: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Counts and normalised share per value (share within ``by``)."""
    c = reviews.groupBy(*by, value).agg(F.count(F.lit(1)).alias("cnt"))
    if not by:   # grand total as a scalar subquery over the aggregated rows
        return c.withColumn("share", F.col("cnt") / c.agg(F.sum("cnt")).scalar())
    return c.withColumn("share", F.col("cnt") / F.sum("cnt").over(Window.partitionBy(*by)))


def pivot_counts(reviews: DataFrame, key: str, pivot: str, values: Sequence, prefix: str) -> DataFrame:
    """Key x value count matrix with zeros (explicit values: no extra job)."""
    p = reviews.groupBy(key).pivot(pivot, list(values)).count().na.fill(0)
    return p.select(key, *[F.col(str(v)).cast("bigint").alias(f"{prefix}{v}") for v in values])


def monthly_series(reviews: DataFrame, date: str, keys: Sequence[str] = (), value: str | None = None,
                   how: str = "count", unit: str = "month") -> DataFrame:
    """Per key, one row per month (or day) from its first to its last
    period (empty periods kept: count 0 / mean NULL); months are labelled by
    their last day (``month_end``), days by the day (``day``)."""
    keys = list(keys)
    m = F.trunc(F.col(date), "month") if unit == "month" else F.col(date).cast("date")
    r = reviews.where(F.col(date).isNotNull() & ((F.col(value).isNotNull()) if value else F.lit(True)))
    agg = (F.count(F.lit(1)) if how == "count" else F.avg(value)).alias("v")
    per = r.groupBy(*keys, m.alias("month")).agg(agg)
    span = per.groupBy(*keys).agg(F.min("month").alias("_lo"), F.max("month").alias("_hi"))
    step = F.expr("interval 1 month") if unit == "month" else F.expr("interval 1 day")
    spine = span.select(*keys, F.explode(F.sequence("_lo", "_hi", step)).alias("month"))
    out = spine.join(per, [*keys, "month"], "left")
    v = F.coalesce("v", F.lit(0)) if how == "count" else F.col("v")
    label = F.last_day("month").alias("month_end") if unit == "month" else F.col("month").alias("day")
    return out.select(*keys, label, v.alias("count" if how == "count" else "mean"))


def weighted_average_rating(meta: DataFrame, dist: str = "rating_distribution") -> DataFrame:
    """rating_5..rating_1 (default 0) and their weighted mean (0 total -> NULL)."""
    d = F.col(dist)
    cols = {s: F.coalesce(safe_int(F.try_element_at(d, F.lit(str(s)))), F.lit(0)) for s in (5, 4, 3, 2, 1)}
    total = sum(cols.values(), F.lit(0))
    wsum = sum([c * s for s, c in cols.items()], F.lit(0))
    return meta.select("product_id", *[c.alias(f"rating_{s}") for s, c in cols.items()],
                       total.alias("total"),
                       F.try_divide(wsum.cast("double"), F.when(total != 0, total)).alias("avg_rating"))


def histogram(df: DataFrame, value: str, n_bins: int = 50) -> DataFrame:
    """Equal-width bins between min and max (max folded into the last bin)."""
    v = F.col(value).cast("double")
    mm = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()   # one-row subquery
    lo, hi = mm["lo"], mm["hi"]
    idx = F.least(F.floor((v - lo) * n_bins / (hi - lo)).cast("int") + 1, F.lit(n_bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(idx)
    return (df.where(F.col(value).isNotNull()).groupBy(b.alias("bucket"))
              .agg(F.count(F.lit(1)).alias("cnt"), F.min(v).alias("bin_min"), F.max(v).alias("bin_max")))

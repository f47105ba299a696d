"""Sinks (K1-K8): Parquet / CSV / JSON writers for the result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P

FORMATS = ("parquet", "csv", "json")


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
               mode: str = "overwrite") -> None:
    """K2/K4: write a result table; unsupported formats raise ``ValueError``.

    No ``coalesce(1)``: file count follows the data, so the write stays
    parallel at scale (small stats tables come out small anyway)."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)


def save_tables(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """K4: one folder per table under ``root``."""
    out = []
    for name, df in tables.items():
        p = f"{root}/{name}"
        save_table(df, p, fmt)
        out.append(p)
    return out


def summary_document(tables: Mapping[str, DataFrame]) -> DataFrame:
    """K5: a single-row JSON document holding small result tables under fixed
    keys.  Only for aggregates whose size is bounded (stats tables); big
    tables stay tables."""
    cols = []
    for name, df in tables.items():
        cols.append(df.agg(F.collect_list(F.struct(*df.columns)).alias("v")).select(F.to_json("v"))
                    .scalar().alias(name))
    first = next(iter(tables.values()))
    return first.sparkSession.range(1).select(*cols)


def stats_document(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = P.STATS_KEYS,
                   meta: str = "data_quality_counters") -> DataFrame:
    """K5: the statistics document: ``meta`` (the counters as one object) and the
    small result tables under their fixed keys."""
    held = tables[meta]
    counters = held.select(F.to_json(F.struct(*held.columns))).scalar().alias("meta")
    body = summary_document({key: tables[name] for key, name in keys.items()})
    return body.select(counters, *body.columns)


def write_nested_by_category(products: DataFrame, reviews: DataFrame, path: str,
                             key: str = "product_id", category: str = "category_file",
                             order: str = "review_pos", chunk: int = 1000) -> None:
    """K1: nested product documents (JSON lines), partitioned by category folder.

    Reviews are nested per (product, chunk of ``chunk`` consecutive positions),
    so no row ever holds more than ``chunk`` reviews however hot a product is;
    a product with more reviews spans several lines (``chunk`` = 0, 1, ...)."""
    rcols = [c for c in reviews.columns if c != key]
    if order in reviews.columns:
        part = F.floor(F.col(order) / chunk).cast("bigint")
        items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in rcols])))
    else:
        part = F.lit(0).cast("bigint")
        items = F.collect_list(F.struct(*[F.col(c) for c in rcols]))
    nested = reviews.groupBy(key, part.alias("chunk")).agg(items.alias("reviews"))
    if order in reviews.columns:
        nested = nested.withColumn("reviews", F.transform("reviews", lambda x: x.dropFields("_o")))
    doc = products.join(nested, key, "left")
    doc.write.mode("overwrite").partitionBy(category).json(path)


def keyword_report(keywords: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """K6: one JSON document per group (level + keys): its counters and the two
    keyword lists, each list at most top-n long (bounded nest)."""
    k = keywords.groupBy("level", *keys, "polarity").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "diff", "pos", "neg", "pos_n", "neg_n",
                                             "support", "balanced_ratio", "score"))).alias("words"))
    pos = k.where("polarity = 'positive'").select("level", *keys, F.col("words").alias("positive_special"))
    neg = k.where("polarity = 'negative'").select("level", *keys, F.col("words").alias("negative_special"))
    cond = ["level", *keys]
    doc = counts.join(pos, cond, "left").join(neg, cond, "left")
    return doc.select(*cond, F.to_json(F.struct(*[c for c in doc.columns if c not in cond])).alias("report"))


def save_skin_types(products: DataFrame, path: str, name: str = "product_name",
                    category: str = "category_normal", label: str = "skin_type") -> None:
    """K7: product name, category and skin-type label as JSON lines."""
    products.select(F.col(name).alias("product_name"), F.col(category).alias("category"),
                    F.col(label).alias("skin_type")).write.mode("overwrite").json(path)


def save_global_metadata(word_freq: DataFrame, overall: DataFrame, root: str) -> None:
    """K3: skin-type word frequency and overall sentiment report as two tables."""
    save_table(word_freq, f"{root}/skin_type_word_frequency", "json")
    save_table(overall, f"{root}/overall_sentiment", "json")

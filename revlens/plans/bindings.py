"""Role bindings: the review/product roles expressed over the driver tables.

* ``reviews_text``   documents LEFT JOIN labels: review_id=doc_id, product_id=source,
                     category=lang, label=quality, tokens from the text.
* ``reviews_scored``  lineitem: product_id=l_partkey, score=ceil(l_quantity/10),
                     date=l_shipdate, helpful_count=round(l_discount*100),
                     has_image=(l_returnflag='R').
* ``products``        part: product_id=p_partkey, name=p_name, brand=p_brand,
                     category=p_type, price=p_retailprice, declared reviews=p_size.

Every binding is a lazy projection over a Parquet scan, so Catalyst prunes
columns and pushes filters into the scan of each query built on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

from .. import params as P
from ..functions import text as TX

TOKEN_SPLIT = "[^a-z0-9]+"

# Full total order over lineitem rows ((l_orderkey, l_linenumber) is not unique).
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster only when the scan yields fewer
    splits than there are cores (e.g. a file with one row group).  On a large
    input with thousands of splits this is a no-op, so no extra shuffle."""
    if is_remote():                                 # no RDD access: leave the scan as is
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()              # planning only, no job
    return df.repartition(target) if splits < target else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def doc_tokens(text_col: Column | str = "text") -> Column:
    """Tokeniser of the Latin-script binding: lower, split on non [a-z0-9], stop-list."""
    return TX.regex_tokens(text_col, TOKEN_SPLIT, True, P.ENGLISH_STOPWORDS)


def reviews_text(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    cols = [F.col("doc_id").alias("review_id"), F.col("source").alias("product_id"),
            F.col("lang").alias("category"), doc_tokens("text").alias("tokens")]
    if with_text:
        cols.append(F.col("text"))
    d = docs.select(*cols)
    return d.join(labels, d["review_id"] == labels["doc_id"], "left").drop("doc_id")


def reviews_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "*",
        F.col("l_partkey").alias("product_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("score"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.round(F.col("l_discount") * 100).cast("int").alias("helpful_count"),
        (F.col("l_returnflag") == "R").alias("has_image"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
                    F.col("p_retailprice").alias("price"), F.col("p_size").alias("total_reviews"))


def product_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metadata as the crawler reports it: declared ``total_reviews``
    (p_size, as string), a ``rating_distribution`` map built from the scored
    reviews (string counts, keys "1".."5") plus an invalid key "0" holding the
    count of returned items, and the category (p_type).  Parts without
    reviews have no distribution."""
    rv = reviews_scored(spark, sf_dir)
    # one pass: a conditional count per score and one for the returned items
    counts = {str(k): F.count_if(F.col("score") == k) for k in P.VALID_SCORES}
    counts["0"] = F.count_if(F.col("l_returnflag") == "R")
    pairs = [x for k, n in counts.items() for x in (F.lit(k), n.cast("string"))]
    dist = rv.groupBy("product_id").agg(F.map_filter(F.create_map(*pairs), lambda k, n: n != "0")
                                        .alias("rating_distribution"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"),
                                            F.col("p_type").alias("category"),
                                            F.col("p_size").cast("string").alias("total_reviews"))
    return p.join(dist, "product_id", "left").select(
        F.col("product_id").cast("string").alias("product_id"), "category", "total_reviews", "rating_distribution")

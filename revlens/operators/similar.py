"""Similar products: the k nearest products by cosine of their vectors.

Content-based neighbours of all products without comparing all pairs:

* Equal vectors are one class, so products with copies cost one vector; a class keeps its
  ``k + 1`` smallest keys, which is all that a list of k neighbours can show.
* A class has one signature per tree: the sides of 32 random hyperplanes.  Its band is the
  shortest beginning of the signature (in steps of four planes) that at most ``limit`` classes
  share, so bands are small whatever the number of products, and dense regions are cut
  further than sparse ones.
* Inside a band the cosines are exact (one matrix product of at most about ``limit`` rows); the
  best of all trees are ranked per class.

If no more than ``limit`` classes exist they are one band and the result is exact; otherwise it is
approximate, and more ``trees`` raise the recall.  Every listed similarity is exact.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vector import norm
from ..session import checkpoint_dir

PLANES, STEP = 32, 4
SALTS = 16


def _signatures(dim: int, trees: int, seed: int):
    """Column function: unit vector -> one signature of ``PLANES`` bits per tree."""
    planes = np.random.default_rng(seed).standard_normal((dim, trees * PLANES))
    bits = 1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64)

    def each(vectors):
        import pandas as pd
        if not len(vectors):
            return pd.Series([], dtype=object)
        sides = np.stack(vectors.to_numpy()) @ planes > 0
        return pd.Series(list(sides.reshape(-1, trees, PLANES) @ bits))

    return F.pandas_udf(each, T.ArrayType(T.LongType()))


def _classes(good: DataFrame, key: str, k: int) -> DataFrame:
    """(u, cid, ids): a row per distinct unit vector, its smallest key and its k + 1 smallest keys."""
    by = Window.partitionBy("u", F.pmod(F.xxhash64(key), F.lit(SALTS))).orderBy(key)
    least = good.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_list(key)), 1, k + 1)        # at most SALTS * (k + 1) keys
    return least.groupBy("u").agg(ids.alias("ids")).withColumn("cid", F.col("ids")[0])


def _bands(classes: DataFrame, dim: int, trees: int, limit: int, seed: int, n: int) -> DataFrame:
    """(tree, level, prefix, part, cid, u): every class once per tree, in its band."""
    first = max(0, int(math.log2(max(1.0, n / limit))) // STEP * STEP - STEP)
    levels = list(range(first, PLANES + 1, STEP))
    sig = (classes.select("cid", "u", F.posexplode(_signatures(dim, trees, seed)("u")).alias("tree", "sig")))

    def prefixes(rows: DataFrame) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit(v).alias("level"), F.shiftright("sig", PLANES - v).alias("prefix"))
                                   for v in levels]))
        return rows.withColumn("_p", each).select(*rows.columns, "_p.level", "_p.prefix").drop("sig")

    counts = (prefixes(sig.groupBy("tree", "sig").agg(F.count(F.lit(1)).alias("n")))
              .groupBy("tree", "level", "prefix").agg(F.sum("n").alias("n")))
    above = counts.where(F.col("n") > limit).select(
        "tree", (F.col("level") + STEP).alias("level"), F.col("prefix").alias("up"))
    open_ = (F.col("level") == first) | F.col("up").isNotNull()          # no shorter beginning is small enough
    done = (F.col("n") <= limit) | (F.col("level") == PLANES)
    leaf = (counts.withColumn("_up", F.shiftright("prefix", STEP)).alias("c")
            .join(above.alias("a"), F.expr("c.tree = a.tree AND c.level = a.level AND c._up = a.up"), "left")
            .select("c.tree", "c.level", "c.prefix", "c.n", "a.up").where(open_ & done)
            .select("tree", "level", "prefix", F.ceil(F.col("n") / limit).alias("parts"),
                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    rows = prefixes(sig.withColumn("salt", F.pmod(F.xxhash64("cid", "tree"), F.lit(SALTS)).cast("int")))
    # more classes than ``limit`` on one whole signature are dealt to parts by their hash
    return (rows.join(leaf, ["tree", "level", "prefix", "salt"])
            .select("tree", "level", "prefix", F.pmod(F.xxhash64("cid"), F.col("parts")).alias("part"), "cid", "u"))


def similar_products(vectors: DataFrame, key: str, vec: str = "vector", k: int = 5, trees: int = 16,
                     limit: int = 2000, seed: int = 7) -> DataFrame:
    """(key, rank, neighbour, similarity): up to ``k`` nearest other products of every product, best
    first, equal similarities by ascending key.

    ``vectors`` has one row per key.  Products whose key or vector is null, whose vector is zero
    or holds null or non-finite entries are on neither side.  All vectors have one length; others
    raise an error.  An empty table gives an empty table."""
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    v = vectors.select(F.col(key).alias(key), F.col(vec).cast("array<double>").alias("v")).where(
        F.col(key).isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    length = norm(F.col("v"))
    good = (v.withColumn("_n", length).where((F.col("_n") > 0) & (F.col("_n") < float("inf")))
            .select(F.col(key), F.transform("v", lambda x: x / F.col("_n")).alias("u"))).checkpoint()
    kind = good.schema[key].dataType
    classes = _classes(good, key, k).checkpoint()
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("u")).alias("lo"), F.max(F.size("u")).alias("hi")).first()
    if size["lo"] != size["hi"]:
        raise ValueError(f"vectors of {size['lo']} to {size['hi']} entries")
    bands = _bands(classes, size["lo"] or 1, trees, limit, seed, size["n"])

    def nearest(pdf):
        import pandas as pd
        x, ids = np.stack(pdf["u"].to_numpy()), pdf["cid"].to_numpy()
        order = np.argsort(ids, kind="stable")
        x, ids = x[order], ids[order]
        own, other, sim = [], [], []
        for at in range(0, len(ids), 256):
            s = x[at:at + 256] @ x.T
            s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
            best = np.argsort(-s, axis=1, kind="stable")[:, :min(k, len(ids) - 1)]
            own.append(np.repeat(ids[at:at + 256], best.shape[1]))
            other.append(ids[best.ravel()])
            sim.append(np.take_along_axis(s, best, axis=1).ravel())
        return pd.DataFrame({"cid": np.concatenate(own), "other": np.concatenate(other), "s": np.concatenate(sim)})

    schema = T.StructType([T.StructField("cid", kind), T.StructField("other", kind), T.StructField("s", T.DoubleType())])
    pairs = (bands.groupBy("tree", "level", "prefix", "part").applyInPandas(nearest, schema)
             .groupBy("cid", "other").agg(F.max("s").alias("s")))
    by = Window.partitionBy("cid").orderBy(F.col("s").desc(), "other")    # at most trees * k rows a class
    top = pairs.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k)
    heads = classes.select("cid", "ids")
    entry = F.struct((-F.col("s")).alias("s"), F.col("id").alias("id"))
    others = (top.join(heads.withColumnsRenamed({"cid": "other"}), "other")
              .select("cid", "s", F.explode("ids").alias("id")))
    same = heads.select("cid", F.lit(1.0).alias("s"), F.explode("ids").alias("id"))
    lists = others.unionByName(same).groupBy("cid").agg(F.array_sort(F.collect_list(entry)).alias("near"))
    salted = classes.select("cid", "u").join(lists, "cid").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    members = good.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    rest = F.slice(F.filter("near", lambda x: x["id"] != F.col(key)), 1, k)
    return (members.join(salted, ["u", "salt"]).select(F.col(key), F.posexplode(rest).alias("_i", "_e"))
            .select(key, (F.col("_i") + 1).alias("rank"), F.col("_e.id").alias("neighbour"),
                    (-F.col("_e.s")).alias("similarity")))

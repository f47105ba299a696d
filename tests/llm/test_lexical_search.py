"""Signature search against a plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    tfs = [(key, Counter(terms(t))) for key, t in docs]
    tfs = [(key, tf, sum(tf.values())) for key, tf in tfs if tf]
    n, total = len(tfs), sum(size for *_, size in tfs)
    df = Counter(t for _, tf, _ in tfs for t in tf)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in wanted.items():
        scored = []
        for key, tf, size in tfs:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in query if t in tf)
            if s > 0:
                scored.append((-s, key is None, key or 0))
        out += [(item, i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def got(docs, items, **more):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in L.search(docs, items, **more).collect()), key=str)


@pytest.mark.parametrize("text", ["", "A-b_c  Ünï 12.5 \x00x\x7fy", "日本 é́ ABC", "__--", "ÀÉ Az"])
def test_terms(text):
    assert [t.decode() for t in L.terms_of(text.encode())] == terms(text)


def test_search_of_the_table(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(docs, items) == want
    # several passes over the queries, and joins without a broadcast
    assert got(docs.repartition(5), items, pass_bytes=300, broadcast_rows=0) == want


def test_odd_rows_ties_and_copies(spark, odd, none):
    items = spark.createDataFrame([(1, "the word1 word2"), (1, "and"), (None, "the"), (2, None), (3, ""), (4, "nowhere"),
                                   (5, "日本 é der"), (6, "AND, the of!"), (7, "__ --")], "item_id long, text string")
    rows = lambda df, *c: [tuple(r[x] for x in c) for r in df.collect()]
    docs = odd.unionByName(odd.filter("doc_id = 4")).withColumn("h", F.lit(1)).withColumn("q", F.lit("x"))
    assert got(docs, items) == brute(rows(docs, "doc_id", "text"), rows(items, "item_id", "text"))
    assert got(none, items) == [] and got(docs, items.limit(0)) == []
    many = spark.range(500).select((500 - F.col("id")).alias("doc_id"), F.lit("same words in all of them").alias("text"))
    some = many.unionByName(spark.createDataFrame([(7, "words"), (600, "other")], "doc_id long, text string"))
    ask = spark.createDataFrame([(1, "words them"), (2, "other same")], "item_id long, text string")
    assert got(some, ask) == brute(rows(some, "doc_id", "text"), rows(ask, "item_id", "text"))


def test_one_key_on_a_third_of_the_rows(spark):
    docs = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"),
                                   F.concat_ws(" ", F.lit("a"), (F.col("id") % 7).cast("string"),
                                               F.repeat(F.concat(F.lit(" t"), (F.col("id") % 11).cast("string")),
                                                        (F.col("id") % 40).cast("int"))).alias("text"))
    items = spark.createDataFrame([(i, f"t{i} a {i % 7}") for i in range(11)], "item_id long, text string")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(docs.repartition(6), items) == want


def test_bounds_are_above_the_scores_and_near(spark, docs):
    """No document's bound is below its score, and few documents have to be scored."""
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    texts = {r.item_id: set(L.terms_of(r.text.encode())) for r in items}
    queries = L.Queries(list(texts), list(texts.values()))
    rows = [(r.doc_id, L.terms_of((r.text or "").encode())) for r in docs.collect()]
    rows = [(k, w) for k, w in rows if w]
    df = Counter(queries.place[t] for _, w in rows for t in set(w) if t in queries.place)
    queries.weigh(len(rows), sum(len(w) for _, w in rows), df)
    size = {k: 8 * (10 + 90 * len(w) * queries.docs // queries.words) for k, w in rows}
    tf = {k: Counter(w) for k, w in rows}
    over = total = 0
    for block in L.signature_index(docs).collect():
        u = L.bounds(block.asDict(), queries)
        for q, terms_ in enumerate(texts.values()):
            for j, key in enumerate(block["keys"]):
                s = sum(int(queries.weight[queries.place[t]]) * (10**9 * tf[key][t] // (1000 * tf[key][t] + size[key]))
                        for t in terms_ if t in tf[key])
                assert u[q, j] >= s
                over, total = over + u[q, j], total + s
    assert over <= 1.1 * total


def test_levels_bound_the_frequency():
    block = L._Block(8)
    for i in range(40):
        counts = Counter({b"x": i + 1, b"y": 1, b"z%d" % i: 2})
        block.add(i, i, i + 4, counts, np.fromiter(counts.values(), np.int64))
    names = ["rows", "bits", "keys", "hashes", "sizes", "terms", "dfs"]
    made = dict(zip(names, block.flush()))
    queries = L.Queries([1], [{b"x"}])
    queries.weigh(40, sum(range(4, 44)), {0: 5})
    u = L.bounds(made, queries)[0]
    fixed = queries.length_part(np.array(made["sizes"]))
    w = int(queries.weight[0])
    edges = [*(L.LEVELS[1:] - 1).tolist()]
    for i in range(40):
        top = next(x for x in edges if x >= i + 1)              # the highest frequency of the level
        assert u[i] == w * (10**9 * top // (1000 * top + fixed[i])) >= w * (10**9 * (i + 1) // (1000 * (i + 1) + fixed[i]))

"""Near-duplicates against brute force."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from revlens.llm.components import components
from revlens.llm.embedding_dedup import cosine_components
from revlens.llm.simhash_dedup import simhash_components


def closure(names, links):
    parent = {n: n for n in names}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in names}


def plain_simhash(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check_simhash(df, **options):
    got = simhash_components(df, **options).collect()
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    prints = [(k, plain_simhash(t)) for k, t in texts]
    distinct = sorted({p for k, p in prints if k is not None})
    group = closure(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 4])
    least = {}
    for k, p in prints:
        if k is not None:
            least[group[p]] = min(k, least.get(group[p], k))
    want = sorted((str(k), p, -1 if k is None else least[group[p]]) for k, p in prints)
    assert sorted((str(r.doc_id), r.fp % 2 ** 64, -1 if r.component_id is None else r.component_id) for r in got) == want


def test_simhash_brute_force(docs):
    check_simhash(docs)


def test_simhash_small_tiles_give_the_same(docs):
    check_simhash(docs, capacity=3)


def test_simhash_odd_rows(odd, none):
    check_simhash(odd)
    assert simhash_components(none).count() == 0


def test_simhash_near_copies(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(i, base.replace("w200", f"x{i}")) for i in range(40)] + [(100, base), (101, base), (200, "another text here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_simhash(df)


def test_embeddings_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 16))
    v = np.concatenate([base, base[:60] + rng.normal(scale=0.05, size=(60, 16)), base[:20], 3 * base[20:40]])
    v = v.astype(np.float32)
    rows = [(int(i), [float(x) for x in e]) for i, e in enumerate(v)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [1.0, None] * 8),
           (1005, [float("inf")] + [0.0] * 15), (1006, [1.0, 0.0]), (1007, [2.0, 0.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("x"))
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near))] + [(1006, 1007)]
    want = closure([*range(len(v)), *range(1000, 1008)], links)
    for options in ({}, {"capacity": 20, "leaf": 8}):
        got = {r.vec_id: r for r in cosine_components(df, **options).collect()}
        assert len(got) == len(rows) + len(odd)
        assert {k: r.component_id for k, r in got.items() if k is not None} == want
        assert [got[i].n_links for i in range(len(v))] == near.sum(axis=1).tolist()
        assert got[1000].n_links == 0 and got[1006].n_links == 1 and got[None].component_id is None
        assert all(got[k].kept == (want[k] == k) for k in want)
    assert cosine_components(df.limit(0)).count() == 0


def test_pairs_of_tiles_are_not_shuffled(spark, monkeypatch):
    """The plan that compares tiles has no exchange (before: both vectors' tiles were shuffled for every pair)."""
    from revlens.llm import embedding_dedup
    kept, plans = embedding_dedup.stage, {}

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return kept(df, name)

    monkeypatch.setattr(embedding_dedup, "stage", stage)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in e]) for i, e in enumerate(rng.normal(size=(60, 8)))],
                               "vec_id long, embedding array<double>")
    assert cosine_components(df, capacity=5).count() == 60
    assert "Cartesian" in plans["ego-links"] and "Exchange" not in plans["ego-links"]


def test_double_vectors_that_floats_cannot_hold(spark):
    """Tiles keep the precision of their column; -0 is 0 where vectors are compared."""
    x, y = 1e-200, 3e-200
    rows = [(1, [x, y]), (2, [y, x]), (3, [x, y]), (4, [-0.0, 1.0]), (5, [0.0, 1.0]), (6, [1e300, 3e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cosine_components(df, threshold=0.99).collect()}
    assert got == {1: (2, 1), 2: (0, 2), 3: (2, 1), 6: (2, 1), 4: (1, 4), 5: (1, 4)}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(100, i) for i in range(101, 160)]
    df = spark.createDataFrame(chain + star + [(300, 300)] + star[:5], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}
    assert components(df.limit(0)).count() == 0

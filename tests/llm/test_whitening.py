"""The qd solver and the whitening against numpy's dense routines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm.bidiagonal import bidiagonalise, dqds, leading_components, twisted_vector
from revlens.llm.whitening import whiten


def spectrum(values, seed=3):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0]
    return np.linalg.qr(np.diag(np.sqrt(np.array(values, float))) @ q.T)[1]


CASES = [np.triu(np.random.default_rng(i).standard_normal((n, n)) * 10.0 ** np.random.default_rng(i).integers(-3, 4, n))
         for i, n in enumerate([1, 2, 3, 5, 17, 64])] + [
    np.eye(10), np.diag([3, 3, 3, 2, 2, 1.0]), np.zeros((5, 5)), np.diag([1, 0, 0.0]), spectrum([5] * 5 + [1] * 25),
    spectrum([5, 5 - 1e-9, 5 - 2e-9, 4, 4] + [1e-8] * 25), spectrum([9, 8, 7, 6, 6, 6] + [0] * 24),
    spectrum([1e12, 1, 1e-6]), np.outer(np.arange(1, 8.0), np.arange(1, 8.0))]


@pytest.mark.parametrize("r", CASES, ids=range(len(CASES)))
def test_components_are_the_eigenvectors(r):
    values, vectors = leading_components(r, 4)
    want = np.linalg.svd(r)[1] ** 2
    k = len(values)
    assert k == min(4, int((want > 1e-25 * want[0]).sum()) if want[0] else 0)
    assert np.allclose(values, want[:k], rtol=1e-12, atol=0)
    if k:
        assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_small_singular_values_keep_their_digits():
    d, e = np.array([1.0, 1e-4, 1e-8, 1e-12]), np.array([1.0, 1e-4, 1e-8])
    got = np.sqrt(dqds(d, e))
    # the product of the singular values is that of the diagonal, which a dense solver loses
    assert np.isclose(np.prod(got), np.prod(d), rtol=1e-12)
    low = got[-1] ** 2
    z = twisted_vector(d, e, low)
    b = np.diag(d) + np.diag(e, 1)
    assert np.isclose(np.linalg.norm(b @ z), got[-1], rtol=1e-6)


def test_bidiagonal_form():
    r = np.triu(np.random.default_rng(5).standard_normal((9, 9)))
    d, e, v = bidiagonalise(r)
    b = np.diag(d) + np.diag(e, 1)
    assert np.allclose(v.T @ v, np.eye(9)) and np.allclose(v @ b.T @ b @ v.T, r.T @ r)


def brute(rows):
    """rows: (id, vector) without nulls -> per (id, component): n, deviation, |whitened|, explained."""
    x = np.array([np.floor(np.array(v, float) * 256) for _, v in rows]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(values)[::-1][:4]
    e, v = values[order], vectors[:, order]
    white = (x - s / n) @ v / np.sqrt(e)
    out = []
    for (k, _), row, w in zip(rows, x, white):
        dev = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))
        out += [(k, i + 1, n, dev, abs(w[i]), e[i] / values.sum()) for i in range(4)]
    return out


def check(got, rows):
    want = sorted(brute(rows), key=str)
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=str)
    assert [g[:4] for g in sorted(got)] == [w[:4] for w in sorted(want)]
    for g, w in zip(sorted(got), sorted(want)):
        assert np.allclose(g[4:], w[4:], rtol=1e-6, atol=1e-8)


def test_whitening_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = whiten(df).collect()
    fine = [(r.vec_id, r.embedding) for r in df.collect()
            if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)]
    check(got, fine)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    assert got[0].n == len({tuple(np.floor(np.array(v, float) * 256)) for _, v in fine})
    # one sign for all rows
    second = whiten(df.repartition(7)).collect()
    signs = {}
    by = {(r.vec_id, r.component): r.whitened for r in second}
    for r in got:
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened * by[r.vec_id, r.component]))
    assert all(len(v) == 1 for v in signs.values())


def test_odd_vectors_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(11)
    base = [[float(c) for c in v] for v in rng.standard_normal((40, 6))]
    rows = [(i, v, "x", 1) for i, v in enumerate(base)]
    rows += [(100 + i, base[0], "x", 1) for i in range(200)]                       # copies weigh nothing
    rows += [(7, base[7], "y", 2), (None, base[3], None, None)]
    bad = [(500, None, "", 0), (501, [], "", 0), (502, [None] * 6, "", 0), (503, [float("nan")] * 6, "", 0),
           (504, [1.0] * 5 + [float("-inf")], "", 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n string, component int")
    got = whiten(df.repartition(5)).collect()
    assert {r.n for r in got} == {40} and len(got) == 4 * len(rows)
    assert not {r.vec_id for r in got} & {500, 501, 502, 503, 504}
    check([r for r in got if r.vec_id is not None], [(k, v) for k, v, *_ in rows if k is not None])
    assert whiten(df.limit(0)).collect() == []
    assert whiten(df.filter("vec_id >= 500 or vec_id = 1")).collect() == []           # one distinct vector
    two = whiten(df.filter("vec_id in (1, 2)")).collect()                              # one direction
    assert {(r.component, round(abs(r.whitened), 9)) for r in two} == {(1, 1.0)}


def test_lengths_are_fitted_apart_and_large_entries(spark):
    rng = np.random.default_rng(2)
    five = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((30, 5)))]
    seven = [(50 + i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((20, 7)))]
    got = whiten(spark.createDataFrame(five + seven, "vec_id long, embedding array<float>")).collect()
    as_float = lambda rows: [(k, np.array(v, np.float32).tolist()) for k, v in rows]
    check([r for r in got if r.vec_id < 50], as_float(five))
    check([r for r in got if r.vec_id >= 50], as_float(seven))
    large = [(i, [float(c) * 1e13 for c in v]) for i, v in enumerate(rng.standard_normal((30, 5)))]
    got = whiten(spark.createDataFrame(large, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in got} == {None} and got[0].identity_error < 1e-6


def test_tree_of_factors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((300, 3)))]
    import revlens.llm.whitening as W
    fan, W.FAN_IN = W.FAN_IN, 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("z", F.lit(1)),
                     components=3).collect()
    finally:
        W.FAN_IN = fan
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    x = np.floor(np.array([v for _, v in rows]) * 256)
    c = x - x.mean(0)
    values = np.linalg.eigvalsh(c.T @ c / len(x))[::-1]
    assert np.allclose(sorted({r.explained for r in got}, reverse=True), values / values.sum(), rtol=1e-12)

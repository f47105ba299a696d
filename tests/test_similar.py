import numpy as np
import pytest

from revlens.operators.similar import similar_products

SCHEMA = "p long, vector array<double>"


def brute(rows, k):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = np.round(x @ x.T, 9)
    return {i: [(ids[j], s[a, j]) for j in sorted((j for j in range(len(ids)) if j != a), key=lambda j: (-s[a, j], ids[j]))][:k]
            for a, i in enumerate(ids)}


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["p"], r["rank"])):
        out.setdefault(r["p"], []).append((r["neighbour"], r["similarity"]))
        assert r["rank"] == len(out[r["p"]])
    return out


def clusters(n, size, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n, dim))
    return [(c * size + j, [float(x) for x in centres[c] + 0.25 * rng.standard_normal(dim)])
            for c in range(n) for j in range(size)]


def test_one_band_is_exact_with_copies_and_ties(spark):
    rows = clusters(12, 5, 16, 1)
    rows += [(1000 + i, rows[0][1]) for i in range(9)]                     # copies of product 0
    rows += [(2000, [2 * x for x in rows[7][1]])]                          # same direction
    got = lists(similar_products(spark.createDataFrame(rows, SCHEMA), "p", k=4))
    want = brute(rows, 4)
    assert set(got) == set(want)
    for p in want:
        assert [s for _, s in got[p]] == pytest.approx([s for _, s in want[p]], abs=1e-9)
    assert [i for i, _ in got[1005]] == [0, 1000, 1001, 1002] and [i for i, _ in got[0]] == [1000, 1001, 1002, 1003]
    assert got[7][0][0] == 2000 and got[2000][0][0] == 7


def test_many_bands_keep_the_recall(spark):
    rows = clusters(150, 8, 32, 2)
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = lists(similar_products(df, "p", k=5, limit=100)), brute(rows, 5)
    hits = sum(len({i for i, _ in got.get(p, [])} & {i for i, _ in want[p]}) for p in want)
    assert hits >= 0.9 * 5 * len(rows)
    x = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for p, near in got.items():
        assert all(s == pytest.approx(float(x[p] @ x[i]), abs=1e-9) for i, s in near)


def test_more_equal_signatures_than_a_band(spark):
    # near-equal vectors share all planes and are dealt to parts; every product still gets its list
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in 1 + 1e-7 * rng.standard_normal(8)]) for i in range(300)]
    got = lists(similar_products(spark.createDataFrame(rows, SCHEMA), "p", k=3, limit=20))
    assert set(got) == set(range(300)) and all(len(v) == 3 and v[-1][1] > 0.999999 for v in got.values())


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]),
            (None, [1.0, 1.0]), (6, [float("inf"), 0.0]), (7, [1.0, 1.0]), (8, [-1.0, 0.0])]
    got = lists(similar_products(spark.createDataFrame(rows, SCHEMA), "p", k=5))
    assert {p: [i for i, _ in v] for p, v in got.items()} == {1: [7, 8], 7: [1, 8], 8: [7, 1]}
    one = spark.createDataFrame(rows[:2], SCHEMA)
    assert similar_products(one, "p").count() == 0
    assert similar_products(one.limit(0), "p").count() == 0
    with pytest.raises(ValueError):
        similar_products(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA), "p")


def test_no_cross_join(spark):
    rows = clusters(20, 4, 8, 4)
    plan = similar_products(spark.createDataFrame(rows, SCHEMA), "p")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan

"""Property tests (hypothesis) for the invariants listed in the blueprint."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.operators import clean as C
from revlens.operators import keywords as K
from revlens.operators import sampling as SM
from revlens.operators import stats as S
from revlens.operators import vectors as V

SET = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))

reviews_st = st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.sampled_from(["p1", "p2", "p3"]),
                                st.sampled_from([0, 1, None]),
                                st.lists(st.sampled_from(list("abcde")), max_size=6)),
                      min_size=1, max_size=40)


@SET
@given(reviews_st)
def test_keyword_invariants(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "review_id int, category string, product_id string, label int, tokens array<string>")
    out = K.sentiment_keywords(df, levels=[("global", 1), ("category", 1), ("product", 1)], top_n=3).collect()
    for x in out:
        assert -1.0 <= x["balanced_ratio"] <= 1.0
        assert x["support"] == x["pos_n"] + x["neg_n"] >= 1
        if x["score"] != 0:
            assert (x["score"] > 0) == (x["balanced_ratio"] > 0)
        assert 1 <= x["rank"] <= 3
    # levels add up: global support of a word = sum over categories
    allw = K.sentiment_keywords(df, levels=[("global", 1), ("category", 1), ("product", None)], top_n=100).collect()
    g = {x["word"]: x["support"] for x in allw if x["level"] == "global" and x["polarity"] == "positive"}
    c = {}
    for x in allw:
        if x["level"] == "category" and x["polarity"] == "positive":
            c[x["word"]] = c.get(x["word"], 0) + x["support"]
    assert g == c


@SET
@given(st.lists(st.tuples(st.sampled_from(["p1", "p2"]), st.sampled_from(["d1", "d2"]),
                          st.sampled_from(["n", None]), st.sampled_from(["t", "u", ""]), st.integers(0, 5)),
                max_size=30))
def test_dedupe_idempotent_and_split_partition(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                               "product_id string, date string, nickname string, full_text string, v int, review_pos int")
    once = C.dedupe_reviews(df)
    twice = C.dedupe_reviews(once)
    def key(t):
        return tuple((x is None, str(x)) for x in t)
    assert sorted(map(tuple, once.collect()), key=key) == \
        sorted(map(tuple, twice.select(*once.columns).collect()), key=key)
    w, wo = C.split_by_text(df.withColumn("content", F.lit("")))
    assert w.count() + wo.count() == df.count()


@SET
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=60))
def test_bins_cover_all_in_range(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "review_cnt long")
    out = S.review_count_bins(df, spark).collect()
    assert sum(r["product_cnt"] for r in out) + sum(1 for v in values if v < 1) == len(values)


@SET
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.lists(st.floats(-5, 5), min_size=3, max_size=3)),
                min_size=1, max_size=20))
def test_representative_is_group_max(spark, rows):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k string, id int, vector array<double>")
    rep = {r["k"]: r for r in V.representative(df, "k", "id").collect()}
    import numpy as np
    for k in rep:
        vs = [(i, np.array(v)) for i, (kk, v) in enumerate(rows) if kk == k]
        cen = np.mean([v for _, v in vs], axis=0)
        def cos(v):
            d = np.linalg.norm(v) * np.linalg.norm(cen)
            return 0.0 if d == 0 else float(v @ cen / d)
        best = max(cos(v) for _, v in vs)
        assert abs(rep[k]["representative_similarity"] - best) < 1e-9


@SET
@given(st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(1, 5)), min_size=1, max_size=80),
       st.integers(1, 6))
def test_quota_bounds(spark, rows, target):
    df = spark.createDataFrame([(p, s, i) for i, (p, s) in enumerate(rows)], "product string, score int, i int")
    kept = SM.stratified_quota(df, ["product", "score"], ["i"], target, 0.25, buckets=4, min_split=5)
    sizes = {}
    for p, s in rows:
        sizes[(p, s)] = sizes.get((p, s), 0) + 1
    got = {}
    for r in kept.collect():
        got[(r["product"], r["score"])] = got.get((r["product"], r["score"]), 0) + 1
    for key, n in sizes.items():
        assert got.get(key, 0) == min(n, max(target, int(0.25 * n)))


@SET
@given(st.lists(st.text(alphabet=st.sampled_from(list("가나다 ㅋㅎab1,.!?~ 　\n😀❤️()")), max_size=20),
                min_size=1, max_size=10))
def test_normalize_text_idempotent(spark, texts):
    from revlens.functions.text import normalize_text
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(normalize_text("t").alias("a"))
    rows = once.select("a", normalize_text("a").alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"]
        assert r["a"] == r["a"].strip(" ")

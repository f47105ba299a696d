import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlens.operators import clean as C
from revlens.operators import sampling as SM
from revlens.operators import stats as S
from revlens.operators import vectors as V


def test_bins(spark):
    counts = spark.createDataFrame([(v,) for v in [0, 1, 2, 4, 10, 1000, 5000]], "review_cnt long")
    out = {r["bin"]: r["product_cnt"] for r in S.review_count_bins(counts, spark).collect()}
    assert out["1~1"] == 1 and out["2~2"] == 1 and out["3~4"] == 1 and out["5~9"] == 0
    assert out["10~19"] == 1 and out["1000+"] == 2 and out["500~999"] == 0
    assert sum(out.values()) == 6 and len(out) == 11


def test_describe(spark):
    df = spark.createDataFrame([(1,), (2,), (4,)], "v int")
    r = S.describe(df, "v").first()
    assert r["count"] == 3 and r["mean"] == pytest.approx(2.333333, abs=1e-6)
    assert r["std"] == pytest.approx(1.527525, abs=1e-6)
    assert (r["p50"], r["p75"]) == (2.0, 3.0)
    assert r["p90"] == pytest.approx(3.6) and r["p95"] == pytest.approx(3.8) and r["p99"] == pytest.approx(3.96)


def test_grouped_quantiles_match_pandas(spark):
    import random
    random.seed(1)
    rows = [(k, random.randint(0, 50)) for k in "abc" for _ in range(37)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r["k"]: r for r in S.exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["k"]).collect()}
    import pandas as pd
    pdf = pd.DataFrame(rows, columns=["k", "v"])
    for k, g in pdf.groupby("k"):
        assert got[k]["p10"] == pytest.approx(g.v.quantile(0.1))
        assert got[k]["p90"] == pytest.approx(g.v.quantile(0.9))


def test_representative(spark):
    df = spark.createDataFrame([("p", 1, [1.0, 0.0]), ("p", 2, [0.0, 1.0]), ("p", 3, [1.0, 0.0]),
                                ("z", 1, [0.0, 0.0]), ("z", 2, [0.0, 0.0])], "k string, id int, vector array<double>")
    out = {r["k"]: r for r in V.representative(df, "k", "id").collect()}
    assert out["p"]["representative_review_id"] == 1
    assert out["p"]["representative_similarity"] == pytest.approx(0.894427, abs=1e-6)
    assert out["p"]["product_vector"] == pytest.approx([2 / 3, 1 / 3])
    assert out["z"]["representative_review_id"] == 1 and out["z"]["representative_similarity"] == 0.0


def test_review_vectors_in_vocab_only(spark):
    reviews = spark.createDataFrame([(1, ["a", "oov"]), (2, ["oov"])], "review_id int, tokens array<string>")
    vocab = spark.createDataFrame([("a", [2.0, 4.0])], "word string, vector array<double>")
    out = {r["review_id"]: r["vector"] for r in V.review_vectors(reviews, vocab, dim=2).collect()}
    assert out[1] == [2.0, 4.0] and out[2] == [0.0, 0.0]


def test_quota_and_cap(spark):
    rows = [("p", s, i) for s, n in ((5, 20), (4, 8), (3, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "product string, score int, pos int")
    q = {r["score"]: r["n"] for r in SM.stratified_quota(df, ["product", "score"], ["pos"], 3, 0.25)
         .groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert q == {5: 5, 4: 3, 3: 2}
    items = spark.createDataFrame([("c", i, n) for i, n in enumerate([4, 5, 6, 1])], "cat string, i int, n int")
    kept = [r["n"] for r in SM.cumulative_cap(items, ["cat"], ["i"], "n", 10).orderBy("i").collect()]
    assert kept == [4, 5, 6]


def test_month_spine(spark):
    df = spark.createDataFrame([("p", dt.date(2024, 1, 5), 5), ("p", dt.date(2024, 3, 2), 3)],
                               "product_id string, date date, score int")
    c = {r["month_end"]: r["count"] for r in S.monthly_series(df, "date", ["product_id"]).collect()}
    assert c == {dt.date(2024, 1, 31): 1, dt.date(2024, 2, 29): 0, dt.date(2024, 3, 31): 1}
    m = {r["month_end"]: r["mean"] for r in S.monthly_series(df, "date", ["product_id"], "score", "mean").collect()}
    assert m[dt.date(2024, 2, 29)] is None and m[dt.date(2024, 3, 31)] == 3.0


def test_dedupe_first_wins(spark):
    rows = [("p1", "d", None, "t", 0), ("p1", "d", None, "t", 1), ("p2", "d", None, "t", 0), ("p1", "d", "n", "t", 2)]
    df = spark.createDataFrame(rows, "product_id string, date string, nickname string, full_text string, review_pos int")
    kept = sorted((r["product_id"], r["review_pos"]) for r in C.dedupe_reviews(df).collect())
    assert kept == [("p1", 0), ("p1", 2), ("p2", 0)]


def test_split_and_nullify(spark):
    rows = [("굿", "", 0, False, "  "), (" ", "", 3, True, "x")]
    df = spark.createDataFrame(rows, "full_text string, content string, helpful_count int, has_image boolean, s string")
    w, wo = C.split_by_text(df)
    assert w.count() == 1 and wo.count() == 1
    n = C.nullify_defaults(df, ["s"], ["helpful_count"], ["has_image"]).collect()
    assert n[0]["helpful_count"] is None and n[0]["has_image"] is None and n[0]["s"] is None
    assert n[1]["helpful_count"] == 3 and n[1]["has_image"] is True and n[1]["s"] == "x"


def test_min_reviews(spark):
    reviews = spark.createDataFrame([("a", i) for i in range(29)] + [("b", i) for i in range(30)],
                                    "product_id string, i int")
    products = spark.createDataFrame([("a", "29"), ("b", "30")], "product_id string, total_reviews string")
    assert [r[0] for r in C.min_reviews_filter(reviews, products).collect()] == ["b"]
    assert [r[0] for r in C.min_declared_filter(products).collect()] == ["b"]


def test_product_stats_from_maps(spark):
    meta = spark.createDataFrame(
        [("1", "c", None, {"5": "2", "x": "1"}), ("2", "c", "4", {"4": "1"}), ("3", "d", None, None), ("", "d", "1", None)],
        "product_id string, category string, total_reviews string, rating_distribution map<string,string>")
    prc = {r[0]: r[1] for r in S.product_review_counts(meta).collect()}
    assert prc == {"1": 2, "2": 4, "3": 0}          # a product without an id is in no table
    q = S.data_quality_counters(meta).first()
    assert (q["missing_product_id"], q["invalid_score"], q["missing_rating_distribution"], q["review_cnt_mismatch"]) \
        == (1, 1, 1, 1)
    sd = {r["score"]: r["cnt"] for r in S.score_distribution(meta).collect()}
    assert sd == {5: 2, 4: 1}


def test_union_sources(spark):
    a = spark.createDataFrame([(1, 3, True)], "product_id int, helpful_count int, has_image boolean")
    b = spark.createDataFrame([(2,)], "product_id int")
    u = C.union_sources({"parquet": a, "json": b}, {"helpful_count": F.lit(0), "has_image": F.lit(False)})
    rows = {r["source"]: r for r in u.collect()}
    assert rows["json"]["helpful_count"] == 0 and rows["json"]["label"] is None


def test_split_ordered_rules_equal_plain_windows(spark):
    import random
    random.seed(7)
    rows = [("hot" if random.random() < 0.6 else f"p{random.randint(0, 5)}", random.randint(1, 3),
             random.randint(0, 400), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "product string, score int, k int, i int")
    a = SM.stratified_quota(df, ["product", "score"], ["k", "i"], 3, 0.25, buckets=1)
    b = SM.stratified_quota(df, ["product", "score"], ["k", "i"], 3, 0.25, buckets=16, min_split=50)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    items = df.groupBy("product", "k").agg(F.count(F.lit(1)).alias("n"))
    c = SM.cumulative_cap(items, ["product"], ["k"], "n", 500, buckets=1)
    e = SM.cumulative_cap(items, ["product"], ["k"], "n", 500, buckets=8, min_split=20)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, e.select(*c.columns).collect()))


def test_prepare_reviews_dedupes_on_normalised_text(spark):
    from revlens.operators.clean import RAW_REVIEW
    rows = [("f", 0, 0, "1", "5", "2025.1.2.", "n", "좋아요"), ("f", 0, 1, "2", "4", "2025.01.02", "n", "좋아요 \U0001F600"),
            ("f", 0, 2, "3", "4", "2025.1.3.", "n", "좋아요"), ("f", 1, 0, "1", "5", "2025.1.2.", "n", "좋아요"),
            ("f", 0, 3, "4", "1", "어제", None, "별로"), ("f", 0, 4, "5", "1", "어제.", None, "별로")]
    df = spark.createDataFrame(rows, "source_file string, product_pos int, review_pos int, id string, score string, "
                                     "date string, nickname string, full_text string")
    for c in ["collected_at", "helpful_count", "title", "content"]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    out = sorted((r["product_pos"], r["review_pos"]) for r in C.prepare_reviews(df).collect())
    assert out == [(0, 0), (0, 2), (0, 3), (1, 0)]


def test_review_vectors_are_means_of_known_words(spark):
    rows = [(i, (["good", "fine", "ok", "bad", "zzz%d" % i] * 3)[: i % 6]) for i in range(40)]
    r = spark.createDataFrame(rows, "review_id int, tokens array<string>")
    vocab = V.word_vectors(V.fit_word2vec(r, dim=8, min_count=3, num_partitions=2))
    known = {x["word"]: x["vector"] for x in vocab.collect()}
    got = {x["review_id"]: x["vector"] for x in V.review_vectors(r, vocab, dim=8).collect()}
    for i, tokens in rows:
        vs = [known[t] for t in tokens if t in known]
        want = [sum(c) / len(vs) for c in zip(*vs)] if vs else [0.0] * 8
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_representative_spreads_a_hot_group(spark):
    rows = [(i, "hot" if i % 5 else "small", [float(i % 7), 1.0, float(i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "review_id int, product_id string, vector array<double>")
    a = {r["product_id"]: r for r in V.representative(df, "product_id", "review_id").collect()}
    b = {r["product_id"]: r for r in V.representative(df, "product_id", "review_id", salts=1).collect()}
    assert {k: (r[2], round(r[3], 12)) for k, r in a.items()} == {k: (r[2], round(r[3], 12)) for k, r in b.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = V.representative(df, "product_id", "review_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" in plan[:plan.index("SortMergeJoin")]


def test_describe_sketch_path(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "v double")
    a = S.describe(df, "v").first()
    b = S.describe(df, "v", exact=False).first()
    assert a["count"] == b["count"] == 1000 and a["mean"] == pytest.approx(b["mean"])
    assert abs(a["p50"] - b["p50"]) <= 1.0 and abs(a["p99"] - b["p99"]) <= 1.0


def test_order_statistics_by_ranges_equal_numpy(spark):
    """Exact at any number of distinct values; no window over the whole table."""
    import numpy as np
    rng = np.random.default_rng(3)
    probs = [0.01, 0.25, 0.5, 0.9, 0.999]
    for values in (rng.standard_normal(5000), rng.integers(0, 7, 900).astype(float), np.array([4.0]),
                   np.concatenate([np.zeros(4000), rng.exponential(size=1000)])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
        r = S.describe(df, "v", probs).first()
        assert r["count"] == len(values) and r["mean"] == pytest.approx(values.mean())
        assert [r[c] for c in r.asDict() if c.startswith("p")] == pytest.approx(np.quantile(values, probs).tolist())
        if len(values) > 1:
            assert r["std"] == pytest.approx(values.std(ddof=1))
    empty = spark.createDataFrame([], "v double")
    r = S.describe(empty, "v").first()
    assert (r["count"] or 0) == 0 and r["p50"] is None
    plan = S.describe(spark.range(1000), "id")._jdf.queryExecution().executedPlan().toString()
    # the only exchange to a single partition is that of the partial results
    main = plan.split("Subqueries")[0] if "Subqueries" in plan else plan
    assert "Window" in main
    at = main.index("Window")
    assert "SinglePartition" not in main[at:].split("Subquery")[0]


def test_review_vectors_joined_and_sent_are_equal(spark):
    reviews = spark.createDataFrame([(1, ["a", "b", "a", "z"]), (2, []), (3, ["z"]), (4, ["b"]), (5, None)],
                                    "review_id int, tokens array<string>")
    vocab = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, -4.0])], "word string, vector array<double>")
    for limit in (0, 1 << 20):
        got = {r.review_id: r.vector for r in V.review_vectors(reviews, vocab, dim=2, broadcast_bytes=limit).collect()}
        assert got == {1: [2.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0], 4: [4.0, -4.0], 5: [0.0, 0.0]}


def test_a_large_vocabulary_goes_to_blocks(spark, monkeypatch):
    """vectors go to the blocks that use them; no row is shuffled for each word of a review (before: one for each,
    with a sum of whole vectors for each review and word partition)."""
    import numpy as np
    from revlens.sources import documents as D
    rng = np.random.default_rng(7)
    vectors = {f"w{i}": [float(x) for x in rng.normal(size=3)] for i in range(40)}
    vectors |= {f"s{i}": [i / 2, 1.0, -0.25] for i in range(30)}
    words = [*vectors, "unknown", "other", None]
    rows = [(f"r{i % 45}", [words[k] for k in rng.integers(0, len(words), i % 9)]) for i in range(60)]
    rows += [("none", None), (None, ["w1"]), ("odd", ["unknown", None])]
    r = spark.createDataFrame(rows, "review_id string, tokens array<string>")
    vocab = spark.createDataFrame(list(vectors.items()), "word string, vector array<double>")
    want = {}
    for k in {k for k, _ in rows}:
        v = [vectors[w] for i, t in rows if i == k and k is not None for w in t or [] if w in vectors]
        want[k] = np.mean(v, axis=0) if v else np.zeros(3)
    names = []
    kept = D._stage
    monkeypatch.setattr(D, "_stage", lambda df, name: names.append(name) or kept(df, name))
    for block_tokens, rows_a_batch in ((10, 10_000), (1000, 3)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_batch)
        got = V.review_vectors(r, vocab, dim=3, broadcast_bytes=0, block_tokens=block_tokens).collect()
        assert len(got) == len(rows)
        assert all(x.vector == pytest.approx(list(want[x.review_id]), abs=1e-12) for x in got)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert names == ["coded-reviews", "review-sums"] * 2

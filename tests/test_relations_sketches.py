import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.operators import relations as REL
from revlens.operators import sketches as SK
from revlens.operators import vectors as V


def test_lagged_correlation(spark):
    # volume follows the share of the month before; one month without reviews
    shares = [0.1, 0.5, 0.2, 0.8, 0.4, 0.6]
    volumes = [20, 10, 50, 20, 80, 40]
    rows = [("a", f"2025-{m + 1:02d}-03", i < round(n * s)) for m, (s, n) in enumerate(zip(shares, volumes)) for i in range(n)]
    rows += [("b", "2025-01-05", True), ("b", "2025-03-05", False), (None, "2025-01-01", True), ("a", None, True)]
    df = spark.createDataFrame(rows, "k string, d string, hit boolean").withColumn("d", F.to_date("d"))
    got = {(r["k"], r["lag"]): r for r in REL.lagged_keyword_volume(df, F.col("hit"), "d", ["k"], (0, 1, 2)).collect()}
    assert got["a", 1]["months"] == 5 and got["a", 1]["r"] == pytest.approx(np.corrcoef(shares[:-1], volumes[1:])[0, 1])
    assert got["a", 1]["r"] > 0.99
    assert got["b", 0]["months"] == 2 and got["b", 0]["r"] is None          # no variation of the volume
    assert got["b", 1]["months"] == 1 and got["b", 1]["r"] is None          # the empty month counts as 0 later
    assert got[None, 0]["months"] == 1


def test_effect_within_strata(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(4):
        for _ in range(400):
            image = bool(rng.random() < 0.1 + 0.2 * s)                      # the share of images depends on the stratum
            rows.append((s, image, float(5 * s + (1.5 if image else 0) + rng.standard_normal())))
    rows += [(9, True, 1000.0), (9, False, 0.0), (1, None, 5.0), (1, True, None)]      # one row a side does not count
    df = spark.createDataFrame(rows, "s int, image boolean, v double")
    whole = REL.effect_moments(df, "image", "v", ["s"])
    r = REL.stratified_effect(whole, ["s"]).first()
    assert r["strata"] == 4 and abs(r["effect"] - 1.5) < 4 * r["std_error"] < 0.5
    # moments of two inputs add up to those of one pass
    parts = REL.effect_moments(df.where("v < 5"), "image", "v", ["s"]).unionByName(
        REL.effect_moments(df.where("v >= 5"), "image", "v", ["s"]))
    m = REL.stratified_effect(REL.merge_moments(parts, ["s"]), ["s"]).first()
    assert m["effect"] == pytest.approx(r["effect"]) and m["std_error"] == pytest.approx(r["std_error"])
    none = REL.stratified_effect(whole.where("s = 9"), ["s"]).first()
    assert none["strata"] == 0 and none["effect"] is None


def test_bucket_quantiles_merge_and_stay_within_the_error(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([rng.lognormal(3, 2, 4000), -rng.lognormal(1, 1, 1000), np.zeros(500)])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "v double")
    probs = (0.05, 0.2, 0.5, 0.9, 0.99)
    one = SK.bucket_quantiles(SK.value_buckets(df, "v"), probs).first()
    ordered = np.sort(values)
    assert one["count"] == len(values)
    for p in probs:
        want = ordered[int(np.floor(p * (len(values) - 1)))]
        assert abs(one[f"p{int(round(p * 100))}"] - want) <= 0.01 * abs(want) + 1e-12
    halves = SK.value_buckets(df.where("v < 7"), "v").unionByName(SK.value_buckets(df.where("NOT v < 7 OR v IS NULL"), "v"))
    assert SK.bucket_quantiles(SK.merge_buckets(halves), probs).first() == one


def test_distinct_sketches_merge_to_one_pass(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 2 = 0 k", "id % 25000 v")
    whole = SK.distinct_estimate(SK.distinct_sketch(df, "v", ["k"]), ["k"]).collect()
    for i, part in enumerate((df.where("v < 9000"), df.where("v >= 5000"))):          # stored by run, overlapping
        SK.distinct_sketch(part, "v", ["k"]).write.parquet(f"{tmp_path}/run={i}")
    stored = spark.read.parquet(str(tmp_path))
    merged = SK.distinct_estimate(SK.merge_distinct(stored, ["k"]), ["k"]).collect()
    assert sorted(merged) == sorted(whole)
    assert all(abs(r["distinct_cnt"] - 12500) < 12500 * 0.03 for r in merged)


def test_sentence_vectors_lose_the_common_direction(spark):
    rng = np.random.default_rng(7)
    dim, words = 6, [f"w{i}" for i in range(30)]
    table = {w: rng.standard_normal(dim) + 2 for w in words}                # all share a direction
    texts = [[words[int(j)] for j in rng.zipf(1.5, 12) % 30] for _ in range(80)] + [[], ["unknown"], None]
    reviews = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_id long, tokens array<string>").repartition(4)
    vocab = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in table.items()], "word string, vector array<double>")
    got = {r["review_id"]: np.array(r["vector"]) for r in V.sentence_vectors(reviews, vocab, dim=dim).collect()}
    tokens = [w for t in texts if t for w in t]
    weight = {w: 1e-3 / (1e-3 + tokens.count(w) / len(tokens)) for w in set(tokens)}
    mean = np.array([np.mean([weight[w] * table[w] for w in t if w in table], axis=0)
                     if t and any(w in table for w in t) else np.zeros(dim) for t in texts])
    u = np.linalg.svd(mean)[2][0]
    u *= np.sign(u[np.argmax(np.abs(u))])
    assert np.allclose(V.common_direction(V.weighted_vectors(reviews, vocab, V.word_weights(reviews), dim=dim), dim), u)
    for i, m in enumerate(mean):
        assert np.allclose(got[i], m - (m @ u) * u, atol=1e-12) and abs(got[i] @ u) < 1e-12
    assert not got[80].any() and not got[81].any() and not got[82].any()
    assert not V.common_direction(reviews.select(F.array(*[F.lit(0.0)] * dim).alias("vector")), dim).any()

import math

import pytest
from pyspark.sql import functions as F

from revlens.operators import keywords as K

ROWS = [(1, "c1", "p1", 1, ["a", "a", "b"]), (2, "c1", "p1", 1, ["a"]), (3, "c1", "p1", 0, ["b", "c"]),
        (4, "c1", "p1", 1, []), (5, "c1", "p1", None, ["a"])]
SCHEMA = "review_id int, category string, product_id string, label int, tokens array<string>"


def lists(spark, mdf):
    r = spark.createDataFrame(ROWS, SCHEMA)
    out = K.sentiment_keywords(r, [], [("global", mdf)], top_n=30).collect()
    pos = [x["word"] for x in sorted((x for x in out if x["polarity"] == "positive"), key=lambda x: x["rank"])]
    neg = [x["word"] for x in sorted((x for x in out if x["polarity"] == "negative"), key=lambda x: x["rank"])]
    return out, pos, neg


def test_golden_scores(spark):
    out, pos, neg = lists(spark, 1)
    assert pos == ["a", "b", "c"] and neg == ["c", "b", "a"]
    byw = {x["word"]: x for x in out if x["polarity"] == "positive"}
    want = {"a": (2, 0, 0.833333, 0.0, 1.0, 0.915510), "b": (1, 1, 0.333333, 0.5, -0.5, -0.091551),
            "c": (0, 1, 0.0, 0.5, -1.0, -0.346574)}
    for w, (pn, nn, p, n, br, sc) in want.items():
        x = byw[w]
        assert (x["pos_n"], x["neg_n"]) == (pn, nn)
        assert math.isclose(x["pos"], p, abs_tol=1e-6) and math.isclose(x["neg"], n, abs_tol=1e-6)
        assert math.isclose(x["balanced_ratio"], br, abs_tol=1e-6) and math.isclose(x["score"], sc, abs_tol=1e-6)


def test_thresholds(spark):
    _, pos, _ = lists(spark, 2)
    assert pos == ["a", "b"]
    out, pos, neg = lists(spark, 3)
    assert out == [] and pos == [] and neg == []


def test_levels_rollup_consistent(spark):
    rows = ROWS + [(6, "c2", "p2", 0, ["a", "d"]), (7, "c2", "p3", 1, ["d", "d"])]
    r = spark.createDataFrame(rows, SCHEMA)
    out = K.sentiment_keywords(r, levels=[("global", 1), ("category", 1), ("product", 1)]).collect()
    levels = {x["level"] for x in out}
    assert levels == {"global", "category", "product"}
    for x in out:
        assert -1.0 <= x["balanced_ratio"] <= 1.0
        assert (x["score"] > 0) == (x["balanced_ratio"] > 0) or x["score"] == 0
    # global support of "a" = sum over products
    g = [x for x in out if x["level"] == "global" and x["word"] == "a"][0]
    p = [x for x in out if x["level"] == "product" and x["word"] == "a" and x["polarity"] == "positive"]
    assert g["support"] == sum(x["support"] for x in p)
    counts = K.sentiment_counts(r).where("level = 'global'").first()
    assert (counts["review_count"], counts["pos_count"], counts["neg_count"], counts["token_review_count"]) == \
        (7, 4, 2, 6)


def test_term_frequency(spark):
    r = spark.createDataFrame(ROWS, SCHEMA)
    tf = {(x["review_id"], x["word"]): x["tf"] for x in K.term_frequency(r).collect()}
    assert tf[(1, "a")] == pytest.approx(2 / 3) and tf[(3, "c")] == 0.5


def test_weighted_variant(spark):
    rows = [(1, "c", "p", 1, ["a"], {"a": 0.5}), (2, "c", "p", 0, ["a", "b"], {"a": 0.1, "b": 0.9}),
            (3, "c", "p", 0, ["b"], None)]
    r = spark.createDataFrame(rows, SCHEMA + ", weights map<string,double>")
    out = K.sentiment_keywords_weighted(r, [], [("global", 1)], top_n=5).collect()
    a = [x for x in out if x["word"] == "a"][0]
    # totals count labelled reviews that carry weights: pos 1, neg 1
    assert a["pos"] == pytest.approx(0.5) and a["neg"] == pytest.approx(0.1) and a["balanced_ratio"] == 0.0


def test_group_word_frequency(spark):
    rows = [(1, ["지성", "좋아"]), (2, ["건성", "지성인", "좋아"]), (3, ["보통"])]
    r = spark.createDataFrame(rows, "review_id int, tokens array<string>")
    out = {(x["group"], x["word"]): x["cnt"] for x in K.group_word_frequency(r).collect()}
    assert out[("지성", "좋아")] == 2 and out[("건성", "좋아")] == 1 and ("민감성", "좋아") not in out


def test_top_tokens_global_topk(spark):
    df = spark.createDataFrame([(["x", "y", "x"],), (["z", "y", "x"],)], "product_tokens array<string>")
    out = [(x["rank"], x["word"], x["cnt"]) for x in K.top_tokens(df, top_n=2).orderBy("rank").collect()]
    assert out == [(1, "x", 3), (2, "y", 2)]


def test_tfidf_factorised_equals_explicit_weights(spark):
    rows = [(1, "c1", "p", 1, ["a", "a", "b"]), (2, "c1", "p", 0, ["b", "c"]), (3, "c2", "p", 1, ["a", "c"]),
            (4, "c2", "p", 0, ["c", "c", "d"]), (5, "c2", "p", None, ["d"]), (6, "c1", "p", 1, [])]
    r = spark.createDataFrame(rows, SCHEMA)
    lv = [("global", 1), ("category", 1)]
    fast = K.sentiment_keywords_tfidf(r, ["category"], lv, top_n=10)
    rt = r.where(F.size("tokens") > 0)
    w = K.tfidf_weights(rt)
    slow = K.score_keywords(K.long_weight_contributions(w, rt, ["category"]),
                            K.class_totals(rt, ["category"], ["global", "category"], tokens=None),
                            ["category"], lv, 10)
    def norm(df):
        return sorted((x["level"], x["category"], x["polarity"], x["rank"], x["word"], round(x["score"], 9),
                       round(x["pos"], 9)) for x in df.collect())
    assert norm(fast) == norm(slow)


def test_tfidf_weights_sort_no_long_table(spark):
    """the frequencies meet the words' counts and the reviews by hashes of the narrow sides."""
    r = spark.createDataFrame([(i, "c", i % 2, ["a", "b", f"w{i}"]) for i in range(9)],
                              "review_id int, category string, label int, tokens array<string>")
    contrib = K.long_weight_contributions(K.tfidf_weights(r), r, ["category"])
    assert str(contrib._jdf.queryExecution().optimizedPlan()).count("strategy=shuffle_hash") == 2
    got = {(x["label"], x["word"]): x["w"] for x in contrib.collect()}
    assert got[(1, "a")] == 0 and abs(got[(1, "w1")] - math.log(9) / 3) < 1e-12


@pytest.mark.parametrize("name", ["sentiment_keywords_weight_map", "sentiment_keywords_long_weights", "sentence_vectors_weighted"])
def test_texts_are_tokenised_once(spark, name):
    """the tokens are staged; the table of texts is not read again by the result."""
    import tempfile
    from revlens.plans import catalog
    d = tempfile.mkdtemp(prefix="run-docs-", dir="/tmp")
    spark.range(60).selectExpr("id doc_id", "concat('good red w', id % 5) text", "if(id % 2 = 0, 'de', 'es') lang", "'s' source",
                               "9L n_chars").write.parquet(f"{d}/documents.parquet")
    spark.range(50).selectExpr("id doc_id", "cast(id % 2 as int) quality", "0 toxic").write.parquet(f"{d}/labels.parquet")
    spark.range(30).selectExpr("id vec_id", "transform(sequence(1, 64), x -> cast(x + id as float)) embedding",
                               "cast(id % 3 as int) label").write.parquet(f"{d}/embeddings.parquet")
    df = catalog.QUERIES[name](spark, d)
    assert df.count() > 0
    assert not [f for f in df.inputFiles() if "documents.parquet" in f]


def test_weights_of_common_and_rare_words(spark):
    """Words above and below the bound, repeated ids, empty lists, nulls and the mark between the words of a list."""
    import math
    rows = [(1, ["a", "b", "a"]), (2, ["a", "c\x01c"]), (3, ["a", None, "b"]), (4, []), (5, None), (6, ["", "a"]),
            (7, ["d", "e"]), (7, ["d", "a"]), (None, ["f", "a"])]
    r = spark.createDataFrame(rows, "review_id int, tokens array<string>")
    n = sum(1 for _, t in rows if t)
    sets = {}
    for k, t in rows:
        sets.setdefault(k, set()).update(w for w in t or [] if w is not None)
    df = {w: sum(w in s for s in sets.values()) for w in set().union(*sets.values())}
    want = sorted((str(k), w, round(sum((t or []).count(w) for i, t in rows if i == k) / len(next(t for i, t in rows if i == k and t))
                                    * math.log(n / df[w]), 9)) for k, s in sets.items() for w in s)
    for bound in (0.0, 0.2, 1.1):
        got = K.tfidf_weights(r, frequent=bound).collect()
        assert sorted((str(x.review_id), x.word, round(x.weight, 9)) for x in got) == want


def test_weights_stay_with_their_review(spark):
    """The long table is not shuffled by what reads it by review (before: three shuffles of all its rows)."""
    r = spark.createDataFrame([(i, ["a", f"b{i % 7}", f"c{i}"], i % 2, "k") for i in range(50)],
                              "review_id int, tokens array<string>, label int, category string")
    w = K.tfidf_weights(r, frequent=0.1)
    maps = w.groupBy("review_id").agg(F.collect_list("word").alias("words"))
    long = K.long_weight_contributions(w, r, ["category"])
    for plan in (maps, long):
        text = plan._jdf.queryExecution().sparkPlan().toString(), plan._jdf.queryExecution().executedPlan().toString()
        top = text[1][:text[1].index("Union")]
        assert "Exchange" not in top, top
    assert maps.count() == 50 and long.count() == 150

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from revlens.plans import jobs as J


def _review(i, score, text, nick="n"):
    return {"id": i, "score": score, "date": "2025.1.%d." % (1 + i % 20), "collected_at": "2025.1.30 10:00:00",
            "nickname": nick, "has_image": i % 2 == 0, "helpful_count": i % 3, "title": "", "content": text,
            "full_text": " " + text}


def _write_fixture():
    d = tempfile.mkdtemp(prefix="run-raw-", dir="/tmp")
    good = ["지성 피부에 좋아요 촉촉", "지성 피부 추천 좋아요", "건성 피부 당김 별로", "민감 피부 따가움 별로", "보통 무난"]
    prods = []
    for p in range(3):
        reviews = [_review(i, [5, 4, 2, 1, 3][i % 5], good[i % 5], nick=f"u{i}") for i in range(12)]
        reviews.append(_review(99, 5, "", nick="x"))                       # no text
        reviews.append(dict(reviews[0], id=100))                           # duplicate of review 0
        prods.append({"product_info": {"product_id": str(p), "brand": "토코보", "category_path": "뷰티 > 토너",
                                       "product_name": f"토코보 지성 토너 {p}", "price": "12,900", "delivery_type": "x",
                                       "total_reviews": "40", "product_url": "u",
                                       "rating_distribution": {"5": "10", "1": "2"}},
                      "reviews": {"total_count": 14, "text_count": 13, "data": reviews}})
    with open(os.path.join(d, "result_토너.json"), "w", encoding="utf-8") as f:
        json.dump({"search_name": "토너", "data": prods}, f, ensure_ascii=False)
    with open(os.path.join(d, "result_bad.json"), "w") as f:
        f.write("{oops")
    return d


def test_preprocessing_job(spark):
    raw = _write_fixture()
    out = tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    paths = J.run_preprocessing(spark, raw, out, stopwords=["피부"], min_reviews=5, w2v_dim=8)
    detail = spark.read.parquet(paths["reviews_detail"])
    # 3 products x (12 text + 1 no-text) reviews, the duplicate removed
    assert detail.count() == 39
    assert detail.where(F.col("product_id").contains("_with_")).count() == 36
    assert detail.where(F.size("tokens") > 0).where(F.array_contains("tokens", "피부")).count() == 0
    prods = spark.read.parquet(paths["products"])
    assert {r["skin_type"] for r in prods.where("text_kind = 'with'").collect()} == {"지성"}
    assert {r["brand"] for r in prods.collect()} == {"tocobo"}
    kw = spark.read.parquet(paths["keywords"])
    assert kw.where("level = 'product'").count() > 0
    vec = spark.read.parquet(paths["product_vectors"])
    assert vec.count() == 3 and all(len(r["product_vector"]) == 8 for r in vec.collect())
    stats = J.run_basic_stats(spark, prods, out + "/eda")
    assert stats["score_distribution"].count() == 2
    assert spark.read.json(out + "/eda/summary").count() == 1


def _product(pid, name, reviews, total="40"):
    return {"product_info": {"product_id": pid, "brand": "b", "category_path": "x > y", "product_name": name,
                             "price": "1", "delivery_type": "x", "total_reviews": total, "product_url": "u",
                             "rating_distribution": {"5": "3"}},
            "reviews": {"total_count": len(reviews), "text_count": len(reviews), "data": reviews}}


def _write_odd_fixture():
    """Repeated, non-numeric and missing ids, a numeric category, a name that cleaning empties,
    reviews with emoji only or a title only, scores 4.0 and ' 5 '."""
    d = tempfile.mkdtemp(prefix="run-raw-", dir="/tmp")
    texts = ["지성 좋아요", "건성 별로", "무난 해요", "촉촉 해요"]

    def four(tag):
        return [_review(i, 5, f"{t} {tag}", nick=f"{tag}{i}") for i, t in enumerate(texts)]
    odd = four("x")
    odd[0]["score"], odd[1]["score"] = 4.0, " 5 "
    odd.append(dict(_review(7, 5, "\U0001f600\U0001f600", nick="emoji")))
    odd.append(dict(_review(8, 5, "", nick="title"), title="제목", full_text=""))
    prods = [_product("1", "토너", four("a")), _product("1", "크림", four("b")), _product("A7", "[지성]", odd),
             _product("B9", "로션", four("d")), _product(None, "없음", four("e"), total=None)]
    with open(os.path.join(d, "result_007.json"), "w", encoding="utf-8") as f:
        json.dump({"search_name": "007", "data": prods}, f, ensure_ascii=False)
    return d


def test_preprocessing_keeps_rows_apart(spark):
    raw = _write_odd_fixture()
    out = tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    paths = J.run_preprocessing(spark, raw, out, min_reviews=3, w2v_dim=4)
    detail = spark.read.parquet(paths["reviews_detail"])
    assert detail.count() == 22 and detail.select("review_key").distinct().count() == 22
    assert {r["category"] for r in detail.select("category").collect()} == {"007"}
    assert detail.where("text_kind = 'without'").count() == 2              # emoji only, title only
    by_nick = {r["nickname"]: r for r in detail.collect()}
    assert (by_nick["x0"]["score"], by_nick["x1"]["score"], by_nick["x0"]["label"]) == (4, 5, 1)
    prods = spark.read.parquet(paths["products"]).collect()
    assert len(prods) == 6                                                  # 5 with text, one also without
    assert {r["skin_type"] for r in prods if r["product_name"] == "[지성]" and r["text_kind"] == "with"} == {"지성"}
    assert {r["skin_type"] for r in prods if r["text_kind"] == "without"} == {None}
    assert spark.read.parquet(paths["product_vectors"]).count() == 5


def test_vectorizer_choice(spark):
    from revlens.operators.vectors import hash_embedding_model
    raw = _write_odd_fixture()
    for bad in ("bert", "both", "other"):
        with pytest.raises(ValueError):
            J.run_preprocessing(spark, raw, "/tmp/never-written", vectorizer=bad)
    out = tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    paths = J.run_preprocessing(spark, raw, out, min_reviews=3, w2v_dim=4, vectorizer="both",
                                make_predict_fn=hash_embedding_model(8), model_dim=8)
    text = spark.read.parquet(paths["reviews_detail"]).where("size(tokens) > 0")
    assert text.where("word2vec IS NULL OR bert IS NULL").count() == 0
    for name, dim in (("word2vec", 4), ("bert", 8)):
        got = spark.read.parquet(paths[f"product_vectors_{name}"]).collect()
        assert len(got) == 5 and all(len(r["product_vector"]) == dim for r in got)


def test_products_without_id_are_in_no_table(spark):
    rows = [("p1", None, "c", "2", {"5": "2"}), (None, None, "c", "7", {"5": "7"}), (" ", "", "c", "9", {"4": "9"}),
            (None, "n4", "c", "1", {"5": "1"})]
    df = spark.createDataFrame(rows, "product_id string, product_no string, category string, total_reviews string, "
                                     "rating_distribution map<string,string>")
    t = J.run_basic_stats(spark, df)
    assert {(r[0], r[1]) for r in t["product_review"].collect()} == {("p1", 2), ("n4", 1)}
    assert [(r["score"], r["cnt"]) for r in t["score_distribution"].collect()] == [(5, 3)]
    assert t["category_product"].first()["product_cnt"] == 2


def _same_names_fixture():
    """Two folders with a file of one name each."""
    d = tempfile.mkdtemp(prefix="run-raw-", dir="/tmp")
    for folder, tag in (("a", "x"), ("b", "y")):
        os.makedirs(os.path.join(d, folder))
        reviews = [_review(i, 5, f"좋아요 {tag}{i}", nick=f"{tag}{i}") for i in range(4)]
        with open(os.path.join(d, folder, "result_x.json"), "w", encoding="utf-8") as f:
            json.dump({"search_name": "x", "data": [_product("1", "토너 " + tag, reviews)]}, f, ensure_ascii=False)
    return d


def test_files_of_one_name_stay_apart(spark):
    out = tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    paths = J.run_preprocessing(spark, _same_names_fixture(), out, min_reviews=3, w2v_dim=4)
    detail = spark.read.parquet(paths["reviews_detail"])
    assert detail.count() == 8 and detail.select("review_key").distinct().count() == 8
    assert spark.read.parquet(paths["products"]).count() == 2
    assert spark.read.parquet(paths["product_vectors"]).count() == 2


def test_file_counters_in_the_statistics_document(spark):
    raw, out = _write_fixture(), tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    open(os.path.join(raw, "result_empty.json"), "w").close()
    paths = J.run_preprocessing(spark, raw, out, min_reviews=5, w2v_dim=4)
    counters = spark.read.parquet(paths["file_counters"])
    assert counters.first().asDict() == {"n_files": 3, "file_read_error": 2, "products_read": 3}
    J.run_basic_stats(spark, spark.read.parquet(paths["products"]), out + "/eda", file_counters=counters)
    meta = json.loads(spark.read.json(out + "/eda/summary").first()["meta"])
    assert meta["n_files"] == 3 and meta["file_read_error"] == 2 and meta["total_products_seen"] > 0


def _category_files(names, folder):
    """Files of products of their own; words and scores differ from file to file."""
    os.makedirs(folder, exist_ok=True)
    words = ["좋아요", "촉촉", "별로", "지성", "건성", "당김"]
    for k, name in names.items():
        prods = []
        for p in range(3):
            texts = [" ".join(words[(i * (k + 2) + j * (p + 1)) % 6] for j in range(1 + (i + k) % 4)) for i in range(30)]
            prods.append(_product(str(10 * k + p), f"토너 {name} {p}",
                                  [_review(i, 1 + (i * 7 + k + p) % 5, t, nick=f"{name}{p}{i}") for i, t in enumerate(texts)]))
        with open(os.path.join(folder, f"result_{name}.json"), "w", encoding="utf-8") as f:
            json.dump({"search_name": name, "data": prods}, f, ensure_ascii=False)


def _rows(df, drop=()):
    def flat(v):
        return round(v, 9) if isinstance(v, float) else str(v)
    cols = [c for c in sorted(df.columns) if c not in drop]
    return sorted(tuple(flat(r[c]) for c in cols) for r in df.collect())


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_incremental_run_equals_one_run_over_all(spark):
    raw, out = tempfile.mkdtemp(prefix="run-raw-", dir="/tmp"), tempfile.mkdtemp(prefix="run-out-", dir="/tmp")
    _category_files({0: "토너", 1: "크림"}, raw + "/first")
    first = J.run_incremental(spark, raw, out, min_reviews=5, w2v_dim=4)
    before = {n: _files(f"{first[n]}/run=1") for n in ("reviews_detail", "word_sums", "products")}
    assert all(before.values())
    again = J.run_incremental(spark, raw, out, min_reviews=5, w2v_dim=4)                # nothing new
    assert again == first and _files(out) == _files(out) and spark.read.parquet(out + "/manifest").count() == 2
    # a run that failed before its manifest: its partition is replaced
    spark.range(5).selectExpr("'x' category", "'y' product_id", "'junk' word", "1d pos_sum", "1d neg_sum", "1L pos_n",
                              "1L neg_n", "1L any_n", "2 run").write.mode("append").partitionBy("run").parquet(first["word_sums"])
    _category_files({2: "팩", 3: "로션"}, raw + "/second/deep")
    with open(os.path.join(raw, "result_bad.json"), "w") as f:
        f.write("{oops")
    paths = J.run_incremental(spark, raw, out, min_reviews=5, w2v_dim=4)
    assert {n: _files(f"{first[n]}/run=1") for n in before} == before                   # earlier files untouched
    assert {r["run"] for r in spark.read.parquet(out + "/manifest").collect()} == {1, 2}
    whole = J.run_preprocessing(spark, raw, tempfile.mkdtemp(prefix="run-out-", dir="/tmp"), min_reviews=5, w2v_dim=4)
    for name in ("keywords", "sentiment_counts", "group_word_frequency"):
        got, want = spark.read.parquet(paths[name]), spark.read.parquet(whole[name])
        assert set(got.columns) == set(want.columns)
        assert _rows(got) == _rows(want) and got.count() > 0, name
    for name in ("reviews_detail", "products"):
        got, want = spark.read.parquet(paths[name]).drop("run"), spark.read.parquet(whole[name])
        assert _rows(got, ("word2vec", "bert")) == _rows(want, ("word2vec", "bert")), name
    vectors = spark.read.parquet(paths["reviews_detail"]).where("size(tokens) > 0 AND word2vec IS NULL")
    assert vectors.count() == 0
    counters = spark.read.parquet(paths["file_counters"]).agg(F.sum("n_files"), F.sum("file_read_error")).first()
    assert tuple(counters) == (5, 1)

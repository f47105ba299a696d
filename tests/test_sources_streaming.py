import json
import os
import tempfile
import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators import clean as C
from revlens.sources import readers as R
from revlens.sources import sinks as SK
from revlens.streaming import incremental as I


def review(i, score, text, nickname="n", date="2025.1.2."):
    return {"id": i, "score": score, "date": date, "collected_at": "2025.1.3 10:00:00", "nickname": nickname,
            "has_image": False, "helpful_count": 0, "title": "", "content": text, "full_text": f" {text}"}


def product(pid, name, reviews, total="1,234"):
    return {"product_info": {"product_id": pid, "brand": "토코보", "category_path": "뷰티 > 선크림",
                             "product_name": name, "price": "12,900", "delivery_type": "x",
                             "total_reviews": total, "product_url": "u", "rating_distribution": {"5": "3", "4": 1}},
            "reviews": {"total_count": len(reviews), "text_count": len(reviews), "data": reviews}}


@pytest.fixture(scope="module")
def raw_dir():
    d = tempfile.mkdtemp(prefix="run-fixture-", dir="/tmp")
    sub = os.path.join(d, "nested")
    os.makedirs(sub)
    doc1 = {"search_name": "스킨", "total_product": 2,
            "data": [product(7, "토너 A", [review(1, 5, "좋아요"), review(2, "2", "별로")]),
                     product("7", "토너 B", [review(1, 4, "좋아요")])]}
    with open(os.path.join(d, "result_스킨_with_text.json"), "w", encoding="utf-8") as f:
        json.dump(doc1, f, ensure_ascii=False)
    name = unicodedata.normalize("NFD", "result_선크림 팩_without_text.json")
    with open(os.path.join(sub, name), "w", encoding="utf-8") as f:
        json.dump({"search_name": "선크림", "data": [product(9, "선크림", [])]}, f, ensure_ascii=False)
    with open(os.path.join(d, "result_bad_with_text.json"), "w") as f:
        f.write("{oops")
    return d


def test_read_nested_json(spark, raw_dir):
    raw = R.read_search_json(spark, raw_dir).cache()
    rows = raw.select("category_file", "file_role", "_corrupt_record").collect()
    cats = sorted((r["category_file"], r["file_role"]) for r in rows)
    assert ("스킨", "with_text") in cats and ("선크림 팩", "without_text") in cats
    assert sum(1 for r in rows if r["_corrupt_record"] is not None) == 1     # bad file kept, counted
    products = C.unnest_products(raw.where(F.col("_corrupt_record").isNull()))
    assert products.count() == 3
    flat = C.flatten_reviews(products.select("category_file", "product_pos", "product"),
                             ["category_file", "product_pos"])
    assert flat.count() == 3
    typed = C.format_reviews(flat)
    r = {(x["product_pos"], x["review_pos"]): x for x in typed.collect()}
    assert r[(0, 1)]["score_int"] == 2 and r[(0, 1)]["label"] == 0 and str(r[(0, 0)]["date_parsed"]) == "2025-01-02"
    raw.unpersist()


def test_resolve_inputs_prefers_with_text(spark, raw_dir):
    df = R.resolve_inputs(spark, raw_dir)
    assert {r[0] for r in df.select("file_role").distinct().collect()} == {"with_text"}


def test_filter_in_pushdown(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.range(100).withColumnRenamed("id", "k").write.parquet(d + "/t")
    df = R.read_table(spark, d + "/t")
    out = R.filter_in(df, "k", [1, 5, 7])
    assert sorted(r[0] for r in out.collect()) == [1, 5, 7]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "In(k" in plan
    ids = spark.createDataFrame([(3,), (4,)], "x long")
    assert sorted(r[0] for r in R.filter_in(df, "k", ids).collect()) == [3, 4]


def test_sinks(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    SK.save_table(df, d + "/p", "parquet")
    SK.save_table(df, d + "/c", "csv")
    assert spark.read.parquet(d + "/p").count() == 1
    with pytest.raises(ValueError):
        SK.save_table(df, d + "/x", "xlsx")
    doc = SK.summary_document({"t1": df, "t2": df}).first()
    assert json.loads(doc["t1"]) == [{"x": 1, "y": "a"}]


def test_incremental_batch(spark):
    cand = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "url string")
    done = spark.createDataFrame([("u2",)], "url string")
    assert sorted(r[0] for r in I.new_inputs(cand, done, "url").collect()) == ["u1", "u3"]
    prev = spark.createDataFrame([("u2", 1), ("u3", 1)], "url string, v int")
    fresh = spark.createDataFrame([("u3", 2), ("u1", 2)], "url string, v int")
    out = sorted((r["url"], r["v"], r["origin"]) for r in I.backfill(prev, fresh, "url").collect())
    assert out == [("u1", 2, "new"), ("u2", 1, "backfill"), ("u3", 2, "new")]


def test_available_now_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="run-src-", dir="/tmp")
    sink = tempfile.mkdtemp(prefix="run-sink-", dir="/tmp") + "/out"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    schema = ev.schema
    ev.where("event_id < 100").write.mode("append").parquet(src)

    def transform(b):
        return b.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))

    I.run_available_now(spark, src, schema, transform, sink, "t1-" + os.path.basename(src))
    first = spark.read.parquet(sink).count()
    ev.where("event_id >= 100").write.mode("append").parquet(src)
    I.run_available_now(spark, src, schema, transform, sink, "t1-" + os.path.basename(src))     # only the new file
    total = spark.read.parquet(sink).groupBy("event_type").agg(F.sum("n").alias("n"))
    batch = transform(ev)
    assert first > 0
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, batch.collect()))


def test_resume_knows_all_earlier_rows(spark):
    src = tempfile.mkdtemp(prefix="run-src-", dir="/tmp")
    sink = tempfile.mkdtemp(prefix="run-sink-", dir="/tmp") + "/out"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    name = "resume-" + os.path.basename(src)
    for part in (ev.where("event_id < 50"), ev.where("event_id < 80"), ev):    # every run repeats what came before
        part.unionByName(part).write.mode("append").parquet(src)
        I.run_new_rows(spark, src, ev.schema, ["event_id"], sink, name)
    got = spark.read.parquet(sink)
    assert got.count() == ev.select("event_id").distinct().count() == got.select("event_id").distinct().count()
    assert got.select("batch").distinct().count() == 3


def test_stream_dedupe_and_rate(spark):
    src = tempfile.mkdtemp(prefix="run-src-", dir="/tmp")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.unionByName(ev).write.mode("append").parquet(src)          # every event twice
    s = spark.readStream.schema(ev.schema).parquet(src)
    d = I.dedupe_within_watermark(s, ["event_id"], "ts", "1 day")
    q = d.writeStream.format("memory").queryName("dedup_t").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup_t").count() == ev.count()
    rate = I.windowed_rate(ev, "ts", F.col("event_type") == "error")
    tot = rate.agg(F.sum("n")).first()[0]
    assert tot == ev.count()


def test_point_filter_nfc_and_reports(spark):
    df = spark.createDataFrame([(unicodedata.normalize("NFC", "선크림_1"), 1)], "product_id string, v int")
    assert R.filter_product(df, unicodedata.normalize("NFD", "선크림_1")).count() == 1
    from revlens.operators import keywords as K
    rows = [(1, "c", "p", 1, ["a", "b"]), (2, "c", "p", 0, ["b"])]
    r = spark.createDataFrame(rows, "review_id int, category string, product_id string, label int, tokens array<string>")
    kw = K.sentiment_keywords(r, [], [("global", 1)])
    counts = K.sentiment_counts(r, [], ["global"])
    rep = SK.keyword_report(kw, counts, []).first()
    doc = json.loads(rep["report"])
    assert doc["review_count"] == 2 and [w["word"] for w in doc["positive_special"]] == ["a", "b"]
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    p = spark.createDataFrame([("n", "c", "지성", "cat1", "p1")],
                              "product_name string, category_normal string, skin_type string, category_file string, product_id string")
    SK.save_skin_types(p, d + "/skin")
    assert spark.read.json(d + "/skin").count() == 1
    rv = spark.createDataFrame([("p1", 1, "x")], "product_id string, review_id int, full_text string")
    SK.write_nested_by_category(p, rv, d + "/nested")
    back = spark.read.json(d + "/nested")
    assert back.count() == 1 and back.first()["reviews"][0]["full_text"] == "x"


def test_weight_pairs_and_vectorizer_choice(spark):
    from revlens.functions.parse import pairs_to_weights
    from revlens.operators.vectors import vectorize_reviews
    df = spark.createDataFrame([([("a", 1.0), ("b", 2.0), ("a", 3.0)],)], "p array<struct<word:string,weight:double>>")
    assert df.select(pairs_to_weights("p")).first()[0] == {"a": 3.0, "b": 2.0}
    r = spark.createDataFrame([(1,)], "review_id int")
    out = vectorize_reviews(r, {"word2vec": lambda x: x.select("review_id", F.array(F.lit(1.0)).alias("vector"))})
    row = out.first()
    assert row["word2vec"] == [1.0] and row["bert"] is None


def test_nested_sink_chunks_hot_products(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    p = spark.createDataFrame([("p1", "c1")], "product_id string, category_file string")
    rv = spark.createDataFrame([("p1", i, f"t{i}") for i in range(25)], "product_id string, review_pos int, full_text string")
    SK.write_nested_by_category(p, rv, d + "/n", chunk=10)
    back = spark.read.json(d + "/n").orderBy("chunk").collect()
    assert [len(r["reviews"]) for r in back] == [10, 10, 5]
    assert [x["full_text"] for x in back[0]["reviews"]][:3] == ["t0", "t1", "t2"]


def test_running_totals_resume(spark):
    src = tempfile.mkdtemp(prefix="run-src-", dir="/tmp")
    sink = tempfile.mkdtemp(prefix="run-sink-", dir="/tmp") + "/totals"
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.where("event_id % 2 = 0").write.mode("append").parquet(src)
    name = "totals-" + os.path.basename(src)
    I.run_running_totals(spark, src, ev.schema, ["event_type"], sink, name)
    ev.where("event_id % 2 = 1").write.mode("append").parquet(src)       # second arrival
    I.run_running_totals(spark, src, ev.schema, ["event_type"], sink, name)   # resumes from state
    got = sorted(map(tuple, spark.read.parquet(sink).collect()))
    want = sorted(map(tuple, ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).collect()))
    assert got == want


def test_first_seen_limit(spark):
    from revlens.operators.sampling import first_seen_distinct
    df = spark.createDataFrame([("b", 0, 1), ("a", 0, 2), ("b", 1, 0), ("c", 1, 1)], "link string, page_id int, pos int")
    out = [(r["link"], r["page_id"], r["pos"]) for r in first_seen_distinct(df, "link", ["page_id", "pos"], 2).collect()]
    assert out == [("b", 0, 1), ("a", 0, 2)]


def test_global_metadata_sink(spark):
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    wf = spark.createDataFrame([("지성", 1, "좋아", 3)], "group string, rank int, word string, cnt long")
    ov = spark.createDataFrame([("global", 3, 2, 1)], "level string, review_count long, pos_count long, neg_count long")
    SK.save_global_metadata(wf, ov, d)
    assert spark.read.json(d + "/skin_type_word_frequency").count() == 1
    assert spark.read.json(d + "/overall_sentiment").first()["review_count"] == 3


def test_resume_keeps_the_first_row_by_order(spark):
    """Gaps, replays of old rows and a restart: the row of the first batch stays, the least of it."""
    src = tempfile.mkdtemp(prefix="run-src-", dir="/tmp")
    sink = tempfile.mkdtemp(prefix="run-sink-", dir="/tmp") + "/out"
    name = "first-" + os.path.basename(src)
    schema = T.StructType.fromDDL("k long, at long, v string")
    batches = [[(1, 5, "b"), (1, 3, "a"), (2, 9, "c"), (None, 4, "n")], [(1, 1, "late"), (3, None, "x"), (3, 0, "y")],
               [], [(2, 0, "late"), (None, 0, "late"), (4, 7, "d"), (4, 7, "c")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        I.run_new_rows(spark, src, schema, ["k"], sink, name, order=["at", "v"])
    got = {(r["k"], r["at"], r["v"]) for r in spark.read.parquet(sink).collect()}
    assert got == {(1, 3, "a"), (2, 9, "c"), (None, 4, "n"), (3, None, "x"), (4, 7, "c")}
    assert spark.read.parquet(sink).count() == 5
    # earlier batches are not read: with an empty sink the keys are still known
    spark.createDataFrame([(1, 0, "late"), (5, 0, "new")], schema).write.mode("append").parquet(src)
    I.run_new_rows(spark, src, schema, ["k"], sink + "-2", name, order=["at", "v"])
    assert [r["k"] for r in spark.read.parquet(sink + "-2").collect()] == [5]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != I.ROCKSDB

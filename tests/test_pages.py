"""Product pages, ingest rules, rating map, review blocks and the parser plug-in."""

import json

import pytest

from revlens.functions.parse import identity_key, pairs_to_weights
from revlens.operators import pages as PG
from revlens.plans.jobs import run_basic_stats

SHOP = """<h1 class="product-title twc-text-lg twc-text-black"><span class="twc-font-bold"> Cream &amp; Co </span></h1>
<div class="price-amount final-price-amount">12,900원</div><span class="rating-count-txt">1,234개 상품평</span>
<div class="price-badge"><img src="https://x/rocket-fresh@2x.png"></div>
<div class="twc-text-sm twc-text-blue-600">Brand</div>"""
ARTICLE = """<article class="twc-border-bluegray-200"><i class="twc-bg-full-star"></i><i class="twc-bg-full-star"></i>
<span class="twc-text-[16px]/[19px] twc-font-bold twc-text-bluegray-900">kim</span>
<div class="twc-text-bluegray-700">2025.1.2</div><div class="twc-font-bold twc-text-bluegray-900">Title</div>
<span class="twc-bg-white">Good</span><div class="twc-overflow-x-auto twc-scrollbar-hidden"><img src="a"></div>
<span>7명에게 도움이 됐어요</span></article>"""


@pytest.fixture
def shop(spark):
    official = SHOP + '<span class="twc-ml-[3px]">로켓배송 · 브랜드 본사 정품</span>'
    old = '<h2 class="prod-buy-header__title">Old</h2><span class="rating-count-txt">0개</span>'
    rows = [(1, SHOP + ARTICLE + "<article></article>"), (2, official), (3, "<p>denied</p>"), (4, old), (5, None)]
    return spark.createDataFrame(rows, "page_id long, html string")


def test_product_fields_and_ingest_status(shop):
    got = {r["page_id"]: r for r in PG.ingest_status(PG.product_fields(shop)).collect()}
    one = got[1]
    assert (one["product_name"], one["price"], one["total_reviews"], one["brand"], one["delivery_type"]) == \
        ("Cream & Co", 12900, 1234, "Brand", "로켓프레시")
    assert got[4]["product_name"] == "Old" and got[4]["price"] == 0 and got[4]["delivery_type"] == "일반배송"
    assert [got[i]["ingest_status"] for i in (1, 2, 3, 4, 5)] == ["collect", "official", "unknown", "metadata", "unknown"]


def test_review_blocks(shop):
    (r,) = PG.review_blocks(shop).collect()
    assert r.asDict() == {"page_id": 1, "id": 1, "score": 2, "date": "2025.1.2", "nickname": "kim", "title": "Title",
                          "content": "Good", "has_image": True, "helpful_count": 7, "full_text": "Title Good"}


def test_star_rating_map(spark):
    df = spark.createDataFrame([("최고\n1,234\n좋음 (56)\n보통 n/a",), (None,)], "t string")
    full, none = (r[0] for r in df.select(PG.star_rating_map("t")).collect())
    assert full == {"5": 1234, "4": 56, "3": 0, "2": 0, "1": 0} and set(none.values()) == {0}


def test_parser_plug_in(shop):
    def factory():
        return lambda h: {"size": len(h), "head": h[:3]}
    got = {r["page_id"]: (r["size"], r["head"]) for r in PG.parse_pages(shop, factory, "size long, head string").collect()}
    assert got[3] == (13, "<p>") and got[5] == (None, None) and len(got) == 5


def test_identity_key_and_weight_pairs(spark):
    df = spark.createDataFrame([(1, " a "), (None, " "), (2, None)], "i long, n string")
    assert [r[0] for r in df.select(identity_key("i", "n")).collect()] == \
        ["1__a", "UNKNOWN_ID__UNKNOWN_NAME", "2__UNKNOWN_NAME"]
    kind = "p array<struct<word:string,weight:double>>"
    rows = [([("b", 2.0), ("a", 1.0), ("b", 5.0), ("a", None)],), ([],), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, kind).select(pairs_to_weights("p")).collect()]
    assert got == [{"a": None, "b": 5.0}, {}, {}]


def test_stats_document_has_the_fixed_keys(spark, tmp_path):
    rows = [("p1", "c", "3", {"5": "2", "1": "1"}), (None, "c", "1", {"9": "1"})]
    meta = spark.createDataFrame(rows, "product_id string, category string, total_reviews string, "
                                       "rating_distribution map<string,string>")
    run_basic_stats(spark, meta, str(tmp_path))
    (doc,) = spark.read.json(f"{tmp_path}/summary").collect()
    assert set(doc.asDict()) == {"meta", "category_count", "category_score_part_count", "category_mean_score",
                                 "total_review_bins_count", "summary", "score_count"}
    assert json.loads(doc["meta"])["missing_product_id"] == 1
    assert json.loads(doc["category_count"]) == [{"category": "c", "product_cnt": 1}]

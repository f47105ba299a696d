from pyspark.sql import functions as F

from revlens import params as P
from revlens.functions import parse as PA
from revlens.functions import text as TX


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


def test_normalize_text_golden(spark):
    cases = [
        ("좋아요ㅋㅋㅋㅋ 😀 굿!!", "좋아요 굿!!"),
        ("❤️❤️ good", "❤️❤️ good"),
        ("\u2600\ufe0f", "\ufe0f"),
        ("가격: 1,000원(좋음)", "가격 1,000원좋음"),
        ("a\u00a0\u3000b", "a b"),
        ("", ""),
        (None, None),
    ]
    for src, want in cases:
        assert one(spark, TX.normalize_text, src) == want, src


def test_nfc(spark):
    nfd = "\u1112\u1161\u11ab"  # decomposed syllable
    assert one(spark, TX.nfc, nfd) == "\ud55c"
    assert one(spark, TX.nfc, "plain") == "plain"


def test_clean_product_name_golden(spark):
    cases = [
        ("[1+1] TOCOBO Cotton Soft Sun Stick 19g SPF50+ PA++++, 2개", "tocobo", "cotton soft 선스틱"),
        ("T O C O B O 크림", "tocobo", "크림"),
        ("라운드랩 sun cream 50 ml", None, "라운드랩 sun 크림"),
        ("자작나무 선 크림", None, "자작나무 선크림"),
        ("skin care 토너", None, "스킨케어 스킨"),
        ("3 green tea", None, "reen tea"),
        ("html book", None, "ht머신러닝 book"),
    ]
    df = spark.createDataFrame(cases, "name string, brand string, want string")
    got = df.select("want", TX.clean_product_name("name", "brand").alias("got")).collect()
    for r in got:
        assert r["got"] == r["want"]


def test_brand_with_regex_metacharacters_is_literal(spark):
    df = spark.createDataFrame([("a+b (c) cream", "a+b (c)")], "name string, brand string")
    assert df.select(TX.remove_brand("name", "brand")).first()[0] == "cream"


def test_token_map_keeps_duplicates(spark):
    df = spark.createDataFrame([(["스틱", "프레쉬", "선", "스틱"],)], "t array<string>")
    assert df.select(TX.map_tokens("t")).first()[0] == ["선스틱", "선케어", "선스틱"]


def test_stopwords_preserve_order_and_duplicates(spark):
    df = spark.createDataFrame([(["b", "a", "b", "the", "b"],)], "t array<string>")
    assert df.select(TX.remove_stopwords("t", ["the"] * 20)).first()[0] == ["b", "a", "b", "b"]


def test_category_and_brand(spark):
    assert one(spark, PA.normalize_category, "뷰티 > 스킨케어 > 토너") == "스킨"
    assert one(spark, PA.normalize_category, "A > Sun Cream ") == "선크림"
    assert one(spark, PA.normalize_category, "A > Unknown Leaf") == "unknown leaf"
    assert one(spark, PA.normalize_brand, "  토코보 ") == "tocobo"
    assert one(spark, PA.normalize_brand, "Other") == "other"
    assert one(spark, lambda c: PA.category_from_path(c, "leaf"), "  ") == P.UNKNOWN_CATEGORY


def test_tokenizers(spark):
    assert one(spark, TX.whitespace_tokens, " a  b　c ") == ["a", "b", "c"]
    assert one(spark, TX.whitespace_tokens, None) == []
    assert one(spark, lambda c: TX.review_tokens(c, ["좋아"]), "좋아 정말 좋아요! abc 12") == ["정말", "좋아요", "12"]
    assert one(spark, TX.parse_token_string, "['red', 'widget']") == ["red", "widget"]


def test_page_text_clean(spark):
    assert one(spark, TX.clean_page_text, "  a\u00a0b\u200b\tc \n") == "a b\tc"
    assert one(spark, TX.strip_html, "<p>a<b>b</b></p>") == "ab"


def test_analyzer_plugin(spark):
    def factory():
        return lambda s: [w for w in s.split() if len(w) > 1]
    assert one(spark, lambda c: TX.analyzer_tokens(c, factory, ["정말"]), "정말 좋 아요 상품") == ["아요", "상품"]


def test_nfc_stable_characters_never_change():
    """Each stays as it is, has no combining class and is no second half of any composition."""
    import unicodedata
    stable = {cp for a, b in TX.NFC_STABLE for cp in range(a, b + 1)}
    assert all(unicodedata.is_normalized("NFC", chr(cp)) and not unicodedata.combining(chr(cp)) for cp in stable)
    seconds = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    for cp in range(0x110000):
        d = unicodedata.decomposition(chr(cp))
        if d and not d.startswith("<") and " " in d:
            seconds.add(int(d.split()[1], 16))
    assert not stable & seconds


def test_class_complement_equals_the_plain_one(spark):
    """F8: the pattern of removed characters has an empty member, which changes no match."""
    import re
    assert "&&" in TX.outside("a-z ")
    text = "aZ9 \t\n\r.,!?~éüㅋㄱ가\U0001f600́-_ o" * 3
    for keep in ("a-zA-Z0-9 \\t\\n\\r.,!?~", "a-z ㄱ-ㅎ", "a-z\\s", r"가-힣0-9\s"):
        got = one(spark, lambda c: F.regexp_replace(c, TX.outside(keep) + "+", "|"), text)
        assert got == re.sub(f"[^{keep}]+", "|", text), keep


def test_analyzer_holds_few_texts_at_once(spark):
    """the tokens of a whole batch are never Python objects together."""
    import pyarrow as pa
    texts = pa.array(["x" * 1000, None, "", "y" * 5000, "z"] * 40)
    pieces = list(TX._slices(texts, 10_000))
    assert pa.concat_arrays(pieces).equals(texts) and len(pieces) > 10
    assert max(sum(len(x or "") for x in p.to_pylist()) for p in pieces) <= 10_000
    assert [len(p) for p in TX._slices(pa.array(["a" * 50, "b" * 50]), 10)] == [1, 1]
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id int, v string")
    got = df.select("id", TX.analyzer_tokens("v", lambda: str.split, keep="a-z\\s").alias("t")).collect()
    assert {r["id"]: r["t"] for r in got} == {1: ["a", "b"], 2: [], 3: []}

from revlens.operators.classify import classify_products


def run(spark, name, texts):
    products = spark.createDataFrame([("p1", name)], "product_id string, product_name string")
    reviews = spark.createDataFrame([("p1", t) for t in texts] or [("zz", "")], "product_id string, full_text string")
    return classify_products(products, reviews).first()["skin_type"]


def test_name_rule_mixed(spark):
    assert run(spark, "민감 지성 토너", []) == "복합/혼합(민감성,지성)"


def test_review_counts_overlap(spark):
    assert run(spark, "토너", ["지성인 지성"]) == "지성"


def test_review_tie(spark):
    assert run(spark, "토너", ["지성인 지성", "건성 건성 건성"]) == "복합/혼합(건성,지성)"


def test_unclassified(spark):
    assert run(spark, "토너", ["좋아요"]) == "미분류"
    assert run(spark, "토너", []) == "미분류"


def test_each_review_by_tokens_text_or_content(spark):
    """A review with tokens is counted by them, one without by its text, or else by its content."""
    from revlens.operators.classify import classify_products, review_keyword_counts
    rows = [("p1", ["지성", "지성인"], "건성 건성 건성", None), ("p1", [], "지성인 지성", "건성"), ("p1", None, "", "건성 건성"),
            ("p1", None, None, "민감"), ("p1", None, None, None)]
    reviews = spark.createDataFrame(rows, "product_id string, tokens array<string>, full_text string, content string")
    groups = {"o": ["지성"], "d": ["건성"], "s": ["민감"]}
    got = {r["group"]: r["cnt"] for r in review_keyword_counts(reviews, "product_id", "full_text", groups, "tokens", "content").collect()}
    assert got == {"o": 3, "d": 2, "s": 1}
    products = spark.createDataFrame([("p1", "토너"), ("p1", "민감 토너"), ("p2", None)], "product_id string, product_name string")
    out = {(r["product_id"], r["product_name"]): r["skin_type"] for r in classify_products(
        products, reviews, groups=groups, tokens="tokens", content="content", unclassified="none").collect()}
    assert out == {("p1", "토너"): "o", ("p1", "민감 토너"): "s", ("p2", None): "none"}


def test_first_rows_by_digest(spark):
    from revlens.operators.clean import keep_first
    rows = [("a", "b:c", 1, "x"), ("a", "b:c", 0, "y"), ("a:b", "c", 2, "z"), (None, "c", 3, "n"), (None, "c", 4, "m"),
            ("", "c", 5, "e"), ("-", "c", 6, "d"), ("c", None, 7, "q")]
    df = spark.createDataFrame(rows, "k1 string, k2 string, i int, v string")
    assert {r["v"] for r in keep_first(df, ["k1", "k2"], ["i"]).collect()} == {"y", "z", "n", "e", "d", "q"}

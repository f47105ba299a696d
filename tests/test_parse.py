import datetime as dt

from pyspark.sql import functions as F

from revlens.functions import parse as PA


def col_values(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_lenient_int(spark):
    assert col_values(spark, PA.lenient_int, ["12,900", "-5", "1.5", "", None]) == [12900, 0, 0, 0, 0]


def test_safe_int(spark):
    assert col_values(spark, PA.safe_int, [" 5 ", "5.0", None, "-3"]) == [5, None, None, -3]


def test_dates(spark):
    got = col_values(spark, PA.parse_dot_date, ["2025.12.12.", "2025.1.2", "어제", None])
    assert got == [dt.date(2025, 12, 12), dt.date(2025, 1, 2), None, None]
    ts = col_values(spark, PA.parse_dot_timestamp, ["2025.1.2 3:04:05", "bad"])
    assert ts[0] == dt.datetime(2025, 1, 2, 3, 4, 5) and ts[1] is None


def test_label(spark):
    assert col_values(spark, PA.sentiment_label, [5, 4, 3, 2, 1, 0, None], "int") == [1, 1, None, 0, 0, 0, None]


def test_extract_count_and_substring_rules(spark):
    got = col_values(spark, PA.extract_count, ["최고\n1,234", "좋음 (56)", "none"])
    assert got == [1234, 56, 0]
    kinds = col_values(spark, PA.classify_by_substring, ["x/rocket-fresh/y", "global_b.png", None])
    assert kinds == ["로켓프레시", "로켓 직구", "일반배송"]


def test_rating_map_coercion(spark):
    df = spark.createDataFrame([({"5": "1,234", "4": "x", "9": "7"},)], "m map<string,string>")
    m = df.select(PA.coerce_rating_map("m")).first()[0]
    assert m == {"5": 1234, "4": 0, "9": 7}


def test_small_helpers(spark):
    df = spark.createDataFrame([("", None, "leaf", 6.0, 0.0, "2024-03-05", 3, None)],
                               "a string, b string, c string, x double, y double, d string, lo long, hi long")
    r = df.select(PA.first_truthy("a", "b", "c").alias("ft"), PA.first_truthy("a", "b", default="UNKNOWN").alias("fd"),
                  PA.safe_ratio("x", "y").alias("sr"), PA.coerce_double(F.lit(" 1.5 ")).alias("cd"),
                  PA.coerce_double(F.lit("x")).alias("cx"), PA.month_key(F.to_date("d")).alias("mk"),
                  PA.product_key(F.lit("cat"), F.lit("with"), F.lit(7)).alias("pk"),
                  PA.bin_label("lo", "hi").alias("b1"), PA.bin_label(F.lit(1), F.lit(3)).alias("b2")).first()
    assert (r["ft"], r["fd"], r["sr"], r["cd"], r["cx"]) == ("leaf", "UNKNOWN", 0.0, 1.5, None)
    assert (r["mk"], r["pk"], r["b1"], r["b2"]) == ("2024-03", "cat_with_7", "3+", "1~2")

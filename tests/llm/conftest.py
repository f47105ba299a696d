import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), os.path.dirname(HERE), HERE]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and a column that clashes."""
    long_text = " ".join(f"word{i % 977} the and" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "  \n\t ", "en", "a", 5), (4, "The and of", "en", "b", 9),
            (4, "The and of", "en", "b", 9), (5, long_text, "en", None, len(long_text)), (None, "der die das", "de", "b", 11),
            (6, "THE   and\nof", "en", "b", 9), (7, "☃ 日本 <|endoftext|> é", "fr", "c", 3)]
    from pyspark.sql import functions as F
    return (spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("mine")).withColumn("size", F.lit(1))
            .withColumn("row", F.lit(2)).withColumn("repeats", F.lit(3)).withColumn("k", F.lit(4)))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)

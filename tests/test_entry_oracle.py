import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"level", "polarity", "rank", "word", "score"} <= set(df.columns)


def test_every_query_has_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    rows_only = {k for k in set(q) - set(o) if q[k].__module__ != "revlens.llm.queries"}
    assert rows_only <= {"word2vec_review_vectors", "embed_batch"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_sf0001(spark, name):
    from oracle_check import compare
    res = compare(spark, "/root/testdata/sf0.001", [name], verbose=True)
    assert res[name][0] == "OK", res[name]

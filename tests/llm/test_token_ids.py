"""Simple-8b coding and the token files against the tokenizer library."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revlens.llm import simple8b
from revlens.llm.token_ids import byte_ids, read_token_ids, token_id_table, write_token_ids

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n", "a\n", "a\n\n", "a\n\nb", "a\n\n\nb", "\na", " a", "a ", "a  b", "a \nb", "a\n b", "x\ty", "don't we'll I'M",
       "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "\x1c a\x1cb", "日本 語", "a b", "a　b", "é ñ ɏ ɐ", "12,345.67 a1b2",
       "...!!! ?!.,", "\r\nline", "word, word. Word; word", "a" * 5000, "\x85x y", "﻿bom"]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_the_library(text):
    want = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    for texts in ([text], ["plain words here.\nand more", text, "some, words", None, text]):
        ids, size = byte_ids(FILE).encode(pa.array(texts, pa.string()))
        parts = np.split(ids, np.cumsum(size)[:-1])
        assert all(p.tolist() == want for t, p in zip(texts, parts) if t == text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é.,'s1\n \t<|€"), max_size=30), min_size=1, max_size=6))
def test_ids_of_any_texts(texts):
    library = Tokenizer.from_file(FILE)
    ids, size = byte_ids(FILE).encode(pa.array(texts, pa.string()))
    assert [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 64), st.integers(0, 2**64 - 1), st.integers(1, 200)), max_size=60))
def test_coding_round_trip(spec):
    ids = np.repeat(np.array([x >> (64 - b) if b else 0 for b, x, _ in spec], np.uint64),
                    np.array([n for *_, n in spec], np.int64))
    words, escapes, lanes = simple8b.encode(ids)
    assert np.array_equal(simple8b.decode(words, escapes), ids)
    assert int(lanes.sum()) == len(words) <= max(1, len(ids))
    # a lane is decoded on its own from the words before it
    if len(lanes) > 1:
        part = simple8b.decode(words[lanes[0]:lanes[0] + lanes[1]], escapes)
        assert np.array_equal(part, ids[simple8b.LANE:2 * simple8b.LANE])


def test_words_hold_as_many_ids_as_fit():
    ids = np.arange(1, 1025, dtype=np.uint64) % 7 + 1            # three bits: twenty a word
    assert len(simple8b.encode(ids)[0]) == 1024 // 20 + 1          # the last four take one word of fifteen bits
    assert len(simple8b.encode(np.full(1024, 50_000, np.uint64))[0]) == 1
    assert simple8b.encode(np.array([2**63 + 5, 3], np.uint64))[1].tolist() == [2**63 + 5]


def check(df, key="doc_id"):
    library = Tokenizer.from_file(FILE)
    got = token_id_table(df, FILE, 2).collect()
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in df.collect()]
    assert len(got) == len(rows)
    want = sorted((str(k), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (last is None or (r.doc_id is not None and r.doc_id >= last))
        at += r.n_tokens
        last = r.doc_id if r.doc_id is not None else last
    return got


def test_files_hold_every_document(docs, odd, none):
    check(docs)
    check(odd)
    assert token_id_table(none, FILE, 2).collect() == []


def test_one_key_on_many_rows_and_long_documents(spark, tmp_path):
    from pyspark.sql import functions as F
    hot = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                  F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    long = spark.createDataFrame([(8, "some words and numbers 12 " * 60_000)], "doc_id long, text string")
    df = hot.unionByName(long)
    check(df)
    # several documents of several blocks each, ids read back
    path = str(tmp_path / "files")
    write_token_ids(long.unionByName(long), FILE, path, 2)
    got = read_token_ids(spark, path, ids=True).orderBy("start").collect()
    want = Tokenizer.from_file(FILE).encode(long.first().text, add_special_tokens=False).ids + [2]
    assert [r.ids for r in got] == [want, want] and got[1].start == len(want) > 2 * simple8b.BLOCK


def test_unfinished_files_are_not_read(spark, tmp_path, docs):
    path = str(tmp_path / "files")
    write_token_ids(docs, FILE, path, 2)
    n = read_token_ids(spark, path).count()
    (tmp_path / "files" / "part-000000-other-9.s8b").write_bytes(b"half a file")
    assert read_token_ids(spark, path).count() == n == docs.count()
    name = next(p for p in sorted((tmp_path / "files").glob("part-*.s8b")) if "other" not in p.name)
    data = bytearray(name.read_bytes())
    data[60] ^= 1
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        read_token_ids(spark, path).collect()


def test_null_lists_and_wrong_ids(spark, tmp_path):
    from revlens.llm.simple8b import Simple8bSource
    spark.dataSource.register(Simple8bSource)
    df = spark.createDataFrame([(None, None), (1, []), (2, [2**40, 2**62, 0])], "key long, ids array<long>").coalesce(1)
    df.write.format("simple8b").mode("overwrite").save(str(tmp_path / "a"))
    got = read_token_ids(spark, str(tmp_path / "a"), ids=True).collect()
    assert [(r.key, r.start, r.ids) for r in got] == [(None, 0, []), (1, 0, []), (2, 0, [2**40, 2**62, 0])]
    with pytest.raises(Exception, match="below zero"):
        spark.createDataFrame([(1, [-1])], "key long, ids array<int>").write.format("simple8b").mode("overwrite").save(
            str(tmp_path / "b"))

"""Token ids of documents in ascending order of their keys, as simple8b files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import task_partitions
from revlens.llm.simple8b import Simple8bSource
from revlens.session import checkpoint_dir

#: Texts of which the library must see the whole: characters beyond Latin, odd white space
#: (runs, at an end, beside a line end) and strings that might be a special token.
WHOLE = "[\x00-\x09\x0b-\x1f\x7f-\xa0]|[^\x00-ɏ]|  |\n | \n|\n\n\n|\n\n$|^ | $|<\\|"
#: Bytes of text taken at a time.
SLICE = 16_000_000
NEWLINE = 198
#: New words of each slice that are encoded by the library as well and compared.
COMPARED = 32


class ByteIds:
    """Ids of whole texts as the ``tokenizers`` library gives them for a byte-level BPE file.

    The pre-tokenizer always cuts before white space that follows a word, so the ids
    of a regular text are those of its words with the one space or line end before
    them.  Distinct words of a slice are encoded once, joined by line ends, with the
    file's own vocabulary as ranks; a few of them are encoded by the library too
    and compared.  Texts with unusual white space, scripts or special strings go to
    the library whole.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        model = self.library.get_vocab(with_added_tokens=False)
        added = self.library.get_added_tokens_decoder()
        letters = sorted(pre_tokenizers.ByteLevel.alphabet())
        # the 256 letters that stand for bytes: printable ones for themselves, the others from U+0100 on
        plain = [b for b in range(256) if chr(b) in letters]
        byte_of = {chr(b): b for b in plain} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model.items() if i not in added}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=ranks, special_tokens={})
        if ranks.get(b"\n") != NEWLINE:
            raise ValueError(f"{path}: the line end is not id {NEWLINE}")
    def whole(self, texts: list[str]) -> list[np.ndarray]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.int32) for e in done]

    def regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(joined ids, ids of each text) of texts that do not match ``WHOLE``."""
        lines = pc.split_pattern(texts, "\n")
        line_end = lines.offsets.to_numpy()[1:]
        words = pc.split_pattern(lines.flatten(), " ")
        first = words.offsets.to_numpy()[:-1]
        coded = pc.dictionary_encode(words.flatten())
        at, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary       # 32 bits: half the traffic
        # 0: a space before the word, 1: nothing, 2: a line end
        before = np.zeros(len(at), np.int32)
        before[first] = 2
        before[first[lines.offsets.to_numpy()[:-1]]] = 1
        key = at * 3 + before
        used = np.flatnonzero(np.bincount(key, minlength=3 * len(names)))
        place = np.empty(3 * len(names), np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        word, kind = pc.take(names, pa.array(used // 3)), used % 3
        shown = pc.binary_join_element_wise(pc.if_else(pa.array(kind == 0), " ", ""), word, "")
        ids, start, length = self.lookup(shown.to_pylist())
        line = kind == 2                                          # the id before a unit is a line end
        at = place[key]
        start, length = (start - line).astype(np.int32)[at], (length + line).astype(np.int32)[at]
        end = np.cumsum(length, dtype=np.int32)
        source = np.repeat(start - (end - length), length)
        source += np.arange(len(source), dtype=np.int32)
        last = words.offsets.to_numpy()[line_end]
        return ids[source], np.diff(np.append(0, np.append(0, end)[last])).astype(np.int64)

    def lookup(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, size): the ids of unit i are ``size[i]`` from ``first[i]`` on; a line
        end stands before each.  Units lie in the order of their first use, so the rare
        ones are read one after the other."""
        full = [u for u in units if u]
        ids = self.ranks.encode_to_numpy("\n" + "\n".join(full) + "\n", disallowed_special=()).astype(np.int32)
        if not full:
            return np.array([NEWLINE], np.int32), np.ones(len(units), np.int64), np.zeros(len(units), np.int64)
        mark = np.flatnonzero(ids == NEWLINE)
        if len(mark) - 1 != len(full):
            raise ValueError("a word holds a line end")
        self.compare(full, ids, mark)
        first, size = mark[:-1] + 1, np.diff(mark) - 1
        if len(full) < len(units):                                # the empty unit: nothing after a line end
            at = np.flatnonzero([not u for u in units])
            at = at - np.arange(len(at))
            first, size = np.insert(first, at, 1), np.insert(size, at, 0)
        return ids, first, size

    def compare(self, new: list[str], ids: np.ndarray, mark: np.ndarray) -> None:
        some = range(0, len(new), max(1, len(new) // COMPARED))
        for i, want in zip(some, self.whole([new[i] for i in some])):
            if not np.array_equal(ids[mark[i] + 1:mark[i + 1]], want):
                raise ValueError(f"the ranks and the library differ on {new[i]!r}")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(joined ids, ids of each text); null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.regular(texts) if len(texts) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        rest = np.flatnonzero(~odd)
        ids, sizes = self.regular(texts.take(pa.array(rest))) if len(rest) else (np.zeros(0, np.int32), [])
        parts: list[np.ndarray] = [None] * len(texts)
        for i, part in zip(rest.tolist(), np.split(ids, np.cumsum(sizes)[:-1]) if len(rest) else []):
            parts[i] = part
        which = np.flatnonzero(odd)
        for i, part in zip(which.tolist(), self.whole(texts.take(pa.array(which)).to_pylist())):
            parts[i] = part
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


@lru_cache(maxsize=2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes, one row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        done = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
        yield at, end
        at = end


def token_lists(docs: DataFrame, tokenizer: str, end_id: int | None = None, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """(key, ids array<int>): the ids of each whole text, and ``end_id`` after them.

    Null text counts as empty.  Null keys and repeated rows stay; the order of rows
    in a partition stays; an empty table gives an empty table; other columns, whatever
    their names, are left out.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_ids(tokenizer)
        for b in batches:
            for lo, hi in slices(b.column(1)):
                ids, size = encoder.encode(b.column(1)[lo:hi])
                end = np.cumsum(size)
                if end_id is not None:
                    ids = np.insert(ids, end, end_id)
                    end = end + np.arange(1, len(end) + 1)
                off = pa.array(np.append(0, end), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32)))],
                    names=["k", "ids"])

    return (docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
            .mapInArrow(each, "k long, ids array<int>").withColumnRenamed("k", key))


def in_key_order(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 bytes_per_task: int = 32_000_000) -> DataFrame:
    """``docs`` in ranges of ascending (key, hash of the text), sorted inside; nulls first.

    The number of ranges follows the size of the texts, so a task has about
    ``bytes_per_task``.  Rows of one key are told apart by their texts, so a key with
    very many rows is cut over several ranges; only equal rows stay together.
    """
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t").cast("long")).alias("n")).first()["n"] or 0
    ranges = max(task_partitions(docs.sparkSession), -(-total // bytes_per_task))
    order = ["k", F.xxhash64("t")]
    return (rows.repartitionByRange(int(ranges), *order).sortWithinPartitions(*order)
            .select(F.col("k").alias(key), F.col("t").alias(text)))


def write_token_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int | None = None, key: str = "doc_id",
                    text: str = "text") -> None:
    """Write the ids of all ``docs`` to ``path`` as simple8b files in ascending order of ``key``
    (null keys first; rows of one key by the hash of their text)."""
    docs.sparkSession.dataSource.register(Simple8bSource)
    token_lists(in_key_order(docs, key, text), tokenizer, end_id, key, text).write.format("simple8b").mode(
        "overwrite").save(path)


def read_token_ids(spark, path: str, ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document of the files in ``path``:
    ``start`` counts the ids of all documents before it."""
    spark.dataSource.register(Simple8bSource)
    return spark.read.format("simple8b").option("ids", str(ids).lower()).load(path)


def token_id_table(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files to a new folder of the shared checkpoint folder and read them back."""
    path = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/token-ids/{uuid.uuid4().hex}"
    write_token_ids(docs, tokenizer, path, end_id, key, text)
    return read_token_ids(docs.sparkSession, path).withColumnRenamed("key", key)

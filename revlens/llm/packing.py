"""Best-fit packing with large-item matching.

Pieces above a third of the capacity share a sequence with at most one other such
piece: they are matched greedily, the largest with the largest that fits.  Smaller
pieces then go, largest first, into the fullest sequence that still takes them.
Lengths are integers up to the capacity, so the plan is made on the histogram of
lengths (at most ``capacity`` numbers) and its size does not depend on the data;
the pieces are then ranked within their length and looked up in the plan.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import stage

#: Words remembered per worker before the table is emptied: bounds memory, not results.
REMEMBER = 400_000
RANK_BITS = 44
#: The tokenizer always splits between a letter and these marks.
TAIL = re.compile(rb"^(.*[A-Za-z])([.,;:?!%&*#$]+)$", re.S)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Words of small Latin letters (a-z and U+00DF to U+00FF): no normaliser changes them, nothing cuts them.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
WORD_END = b"\x01"
#: Words of each batch that are encoded by the library as well and compared.
COMPARED = 32


class PlainWords:
    """Ids of plain words by the file's own vocabulary as merge ranks.

    The file marks the last letter of a word by a suffix; here a byte that no word holds
    follows it, and the pairs with that byte merge first.  All other tokens have the
    order of their ids, which is that of the merges."""

    def __init__(self, tokenizer):
        import json

        import tiktoken
        from tokenizers import pre_tokenizers
        model = json.loads(tokenizer.to_str())["model"]
        suffix = model["end_of_word_suffix"]
        letters = sorted(pre_tokenizers.ByteLevel.alphabet())
        plain = [b for b in range(256) if chr(b) in letters]
        byte_of = {chr(b): b for b in plain} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        tokens = {}
        for token, i in model["vocab"].items():
            whole = token.endswith(suffix) and token != suffix
            stem = token.removesuffix(suffix) if whole else token
            if all(c in byte_of for c in stem):
                raw = bytes(byte_of[c] for c in stem)
                if WORD_END not in raw or len(raw) == 1:
                    tokens[raw + WORD_END if whole else raw] = i
        made = {a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        merged = sorted((i for t, i in model["vocab"].items() if t in made))
        if merged != [model["vocab"][t] for t in dict.fromkeys(
                a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]))]:
            raise ValueError("the ids do not have the order of the merges")
        # letters with their end first, then single bytes, then the merges
        rank = {t: (0 if len(t) == 2 and t.endswith(WORD_END) else 1 if len(t) == 1 else 2, i) for t, i in tokens.items()}
        order = sorted(tokens, key=rank.__getitem__)
        self.id = np.array([tokens[t] for t in order], np.uint32)
        self.line = next(i for i, t in enumerate(order) if t == b"\n")
        self.ranks = tiktoken.Encoding("words", pat_str=r"[^\n]+|\n", special_tokens={},
                                       mergeable_ranks={t: i for i, t in enumerate(order)})

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of every word, 4 bytes each."""
        end = (WORD_END + b"\n").decode()
        ranks = self.ranks.encode_to_numpy(end.join(w.decode() for w in words) + end, disallowed_special=())
        mark = np.flatnonzero(ranks == self.line)
        if len(mark) != len(words):
            raise ValueError("a word holds a line end")
        data = self.id[ranks].astype("<u4").tobytes()
        at = np.append(-1, mark).tolist()
        return [data[4 * lo + 4:4 * hi] for lo, hi in zip(at, at[1:])]


class WordIds:
    """Ids of white-space separated words as little-endian bytes, kept per worker.

    The tokenizer drops white space and matches nothing across it, so the ids of a
    text are those of its words in a row.  It lowers case itself; A-Z are lowered
    before the look-up, unless the text might hold one of its special strings.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(self.tokenizer)
        self.known: dict[bytes, bytes] = {}

    def library(self, words: list[bytes]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in done]

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of every text, 4 bytes each; new words are encoded in one batch."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        known, new, texts_ids = self.known, set(), []
        for t in texts:
            words = (t if b"<|" in t else t.translate(LOWER)).split()
            ids = list(map(known.get, words))
            open_ = list(compress(range(len(ids)), map(not_, ids)))       # places of new words
            missing = [words[i] for i in open_]
            new.update(missing)
            texts_ids.append((ids, open_, missing))
        # a word with marks after its last letter has the ids of the word and of the marks
        marked = {w: m.groups() for w in new if w not in known and (m := TAIL.match(w))}
        new.difference_update(marked)
        new.update(p for parts in marked.values() for p in parts)
        fresh, other = [], []
        for w in new:
            if w not in known:
                (fresh if PLAIN.fullmatch(w) else other).append(w)
        known.update(zip(fresh, self.plain.encode(fresh) if fresh else ()))
        some = fresh[::max(1, len(fresh) // COMPARED)]
        if [known[w] for w in some] != self.library(some):
            raise ValueError("the ranks and the library differ")
        for at in range(0, len(other), 20_000):
            known.update(zip(other[at:at + 20_000], self.library(other[at:at + 20_000])))
        for w, (stem, marks) in marked.items():
            known[w] = known[stem] + known[marks]
        for ids, open_, missing in texts_ids:
            for i, w in zip(open_, missing):
                ids[i] = known[w]
            yield b"".join(ids)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids and a closing id 0,
    cut into pieces of ``capacity`` ids only where it is longer.

    Null text counts as empty (the closing id alone).  Null keys and repeated rows
    are kept as they are.  An empty table gives an empty table.
    """
    kind = docs.schema[key].dataType.simpleString()
    wide = 4 * capacity

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            # a few megabytes of text at a time
            texts, at = [t or b"" for t in b.column(1).to_pylist()], 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size < 4_000_000):
                    size += len(texts[end])
                    end += 1
                for n, ids in enumerate(encode.ids(texts[at:end]), at):
                    ids += b"\0\0\0\0"
                    for k, lo in enumerate(range(0, len(ids), wide)):
                        part = ids[lo:lo + wide]
                        row.append(n)
                        piece.append(k)
                        start.append(lo // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                at = end
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["k", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
            .mapInArrow(each, f"k {kind}, piece int, start long, length long, ids_crc32 long")
            .withColumnRenamed("k", key))


def match_large(count: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences (runs of (length, how many), number of sequences) for lengths above
    a third of the capacity: the largest with the largest partner that fits."""
    left = {n: c for n, c in count.items() if 3 * n > capacity and c > 0}
    out = []
    for big in sorted(left, reverse=True):
        for mate in sorted((n for n in left if n <= min(big, capacity - big)), reverse=True):
            n = left[big] // 2 if mate == big else min(left[big], left[mate])
            if n:
                out.append(([(big, 2)] if mate == big else [(big, 1), (mate, 1)], n))
                left[big] -= n
                left[mate] -= n
            if not left[big]:
                break
        if left[big]:
            out.append(([(big, 1)], left[big]))
            left[big] = 0
    return out


def pack_histogram(count: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Plan for all lengths: (runs of (length, how many), number of such sequences)."""
    by_gap: dict[int, list] = {}
    gaps: list[int] = []

    def put(runs: list, n: int, gap: int) -> None:
        if gap not in by_gap:
            by_gap[gap] = []
            insort(gaps, gap)
        by_gap[gap].append((runs, n))

    for runs, n in match_large(count, capacity):
        put(runs, n, capacity - sum(a * b for a, b in runs))
    for small in sorted((n for n, c in count.items() if 3 * n <= capacity and c > 0), reverse=True):
        rest = count[small]
        at = np.searchsorted(gaps, small)
        todo = [(g, *group) for g in gaps[at:] for group in by_gap.pop(g)]
        del gaps[at:]
        for gap, runs, n in todo:                     # fullest first
            fit = gap // small
            full = min(n, rest // fit)
            if full:
                put([*runs, (small, fit)], full, gap - fit * small)
            rest -= full * fit
            n -= full
            if n and rest:                            # the last few go into one sequence
                put([*runs, (small, rest)], 1, gap - rest * small)
                rest, n = 0, n - 1
            if n:
                put(runs, n, gap)
        fit = capacity // small
        if rest // fit:
            put([(small, fit)], rest // fit, capacity - fit * small)
        if rest % fit:
            put([(small, rest % fit)], 1, capacity - rest % fit * small)
    return [group for g in sorted(by_gap) for group in by_gap[g]]


def placements(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For each run of the plan: first rank of its length, sequence and offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for runs, n in plan:
        offset = 0
        for length, fit in runs:
            rank = used.get(length, 0)
            rows.append((length, rank, fit, base, offset))
            used[length] = rank + n * fit
            offset += length * fit
        base += n
    t = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return {"key": (t[:, 0] << RANK_BITS) + t[:, 1], "rank": t[:, 1], "fit": t[:, 2], "base": t[:, 3],
            "offset": t[:, 4]}


def pack(parts: DataFrame, capacity: int = 2048, key: str = "doc_id", buckets: int = 256) -> DataFrame:
    """``parts`` (from ``pieces``) with sequence_id and offset.

    Ranks within a length come from counts by (length, hash bucket) and a row
    number inside each bucket, so one frequent length is spread over ``buckets``
    windows.  The plan sent to the tasks has a row per run, a few times
    ``capacity`` at most, however many pieces there are.
    """
    spark = parts.sparkSession
    parts = stage(parts.withColumn("_b", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(buckets))), "pack-pieces")
    counts = stage(parts.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(placements(pack_histogram(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_b").orderBy(key, "piece", "ids_crc32")
    ranked = (parts.withColumn("_r", F.row_number().over(inside) - 1).join(first, ["length", "_b"])
              .withColumn("_rank", F.col("_r") + F.col("_first")))

    def place(lengths, ranks):
        import pandas as pd
        t = table.value
        at = np.searchsorted(t["key"], (lengths.to_numpy() << RANK_BITS) + ranks.to_numpy(), "right") - 1
        over = ranks.to_numpy() - t["rank"][at]
        return pd.DataFrame({"sequence_id": t["base"][at] + over // t["fit"][at],
                             "offset": t["offset"][at] + over % t["fit"][at] * lengths.to_numpy()})

    where = F.pandas_udf(place, "sequence_id long, offset long")
    return (ranked.withColumn("_p", where("length", "_rank"))
            .select(key, "piece", "start", "length", "ids_crc32", "_p.sequence_id", "_p.offset"))

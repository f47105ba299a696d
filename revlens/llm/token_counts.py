"""Token counts by byte-pair merging with a heap and a linked list.

The lowest-rank adjacent pair is popped and merged until none is left; the count
is the number of initial symbols less the merges.  No identifiers are made.  A
piece never continues past a word mark (checked when the vocabulary is read),
so the text falls apart into words whose counts are kept per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words remembered per worker before the table is emptied: bounds memory, not results.
REMEMBER = 600_000
NORMAL = 1


class Merger:
    """Counts pieces of words under the merge ranks of a sentencepiece BPE model."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if (spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces) != (
                "identity", True, False, True):
            raise ValueError(f"unsupported normalizer in {path}")
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError("a piece goes on past a word mark")
        self.single = {p for p in self.rank if len(p) == 1}
        if any("\n" in p for p in self.rank):
            raise ValueError("a piece holds a line end")
        self.marked, self.plain = _Counts(self, MARK), _Counts(self, "")
        self.odd = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+")

    def count(self, word: str) -> int:
        """Initial symbols (bytes for unknown characters) less merges."""
        sym: list = list(word)
        n, rank = len(sym), self.rank
        total = sum(1 if c in self.single else len(c.encode()) for c in sym)
        after, back = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := sym[i] + sym[i + 1]) in rank]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i] if sym[i] is not None else n
            if j >= n or sym[i] + sym[j] != pair:
                continue                       # one side was merged meanwhile
            sym[i], sym[j] = pair, None
            total -= 1
            k = after[i] = after[j]
            if k < n:
                back[k] = i
                if (p := pair + sym[k]) in rank:
                    heappush(heap, (rank[p], i, p))
            h = back[i]
            if h >= 0 and (p := sym[h] + pair) in rank:
                heappush(heap, (rank[p], h, p))
        return total

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked, plain, total, first = self.marked, self.plain, 0, True
        for table in (marked, plain):
            if len(table) > REMEMBER:
                table.clear()
        for line in text.split("\n"):
            total += 1                         # the line end is one byte symbol
            words = line.split(" ")
            if "" in words or MARK in line:    # runs of marks: take the general way
                whole = (MARK if first else "") + line.replace(" ", MARK)
                total += sum(map(self.count, self.odd.findall(whole)))
            else:
                total += (marked if first else plain)[words[0]]
                total += sum(map(marked.__getitem__, words[1:]))
            first = False
        return total - 1


class _Counts(dict):
    def __init__(self, merger: Merger, mark: str):
        super().__init__()
        self.merger, self.mark = merger, mark

    def __missing__(self, word: str) -> int:
        n = self[word] = self.merger.count(self.mark + word)
        return n


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


def token_counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
                 limit: int = 4096) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row of ``docs``.

    Null text counts as empty and has no tokens.  Repeated rows stay repeated; a
    null key stays null; an empty table gives an empty table.  ``model`` is a
    path that every executor can read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([m.text(t) if t else 0 for t in texts], pa.int64())],
                names=["k", "n_bytes", "n_tokens"])

    return (docs.select(F.col(key).alias("k"), F.col(text).alias("t"),
                        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("b"))
            .mapInArrow(each, f"k {kind}, n_bytes long, n_tokens long")
            .select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))

"""Document fingerprints: a Merkle tree over sections, paragraphs and word runs.

Sections are blocks between blank lines, paragraphs are lines, leaves are runs of
eight words of a paragraph.  Equal roots mean equal texts; where roots differ only
the differing branches are walked, down to the leaves that were edited.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import task_partitions

RUN = 8


def _hash(data: bytes, level: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=level).digest()


class Tree:
    """hash, size in characters, children (None at a leaf)."""

    __slots__ = ("hash", "size", "children")

    def __init__(self, digest: bytes, size: int, children=None):
        self.hash, self.size, self.children = digest, size, children

    @classmethod
    def over(cls, children: list[Tree], gap: int, level: bytes) -> Tree:
        """Parent of ``children`` that stand ``gap`` characters apart."""
        return cls(_hash(b"".join([c.hash for c in children]), level),
                   sum([c.size for c in children]) + gap * (len(children) - 1), children)

    def leaves(self) -> Iterator[Tree]:
        if self.children is None:
            yield self
        else:
            for c in self.children:
                yield from c.leaves()


def tree(text: str) -> Tree:
    sections = []
    for block in text.split("\n\n"):
        paragraphs = []
        for line in block.split("\n"):
            words = line.split(" ")
            runs = [" ".join(words[i:i + RUN]) for i in range(0, len(words), RUN)]
            paragraphs.append(Tree.over([Tree(_hash(r.encode(), b"run"), len(r)) for r in runs], 1, b"paragraph"))
        sections.append(Tree.over(paragraphs, 1, b"section"))
    return Tree.over(sections, 2, b"root")


def likeness(a: Tree, b: Tree) -> float:
    """Share of characters in leaves that both trees hold, of the longer one."""
    if a.hash == b.hash:
        return 1.0
    mine = Counter()
    for x in a.leaves():
        mine[x.hash, x.size] += 1
    shared = total_b = 0
    for x in b.leaves():
        total_b += x.size
        if mine.get((x.hash, x.size), 0) > 0:
            mine[x.hash, x.size] -= 1
            shared += x.size
    total_a = sum(x.size for x in a.leaves())
    return min(1.0, shared / max(total_a, total_b, 1))


GAP = (2, 1, 1)


def _ends(a: list[Tree], b: list[Tree]) -> tuple[int, int]:
    """Number of equal branches at the start and, of the others, at the end."""
    most, head = min(len(a), len(b)), 0
    while head < most and a[head].hash == b[head].hash:
        head += 1
    tail = 0
    while tail < most - head and a[-1 - tail].hash == b[-1 - tail].hash:
        tail += 1
    return head, tail


def differences(a: Tree, b: Tree, at: int = 0, depth: int = 0) -> list[tuple[int, int]]:
    """Spans (start, end) of ``a`` whose branches differ from ``b``, adjoining spans
    merged; branches that only ``b`` has are an empty span after the one before them.

    Equal branches at the start and at the end are set aside, those between are
    compared in order."""
    if a.hash == b.hash:
        return []
    if a.children is None or b.children is None:
        return [(at, at + a.size)]
    out: list[tuple[int, int]] = []

    def add(s: int, e: int) -> None:
        if out and s - out[-1][1] <= GAP[depth]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))

    head, tail = _ends(a.children, b.children)
    mine, other = a.children[head:len(a.children) - tail], b.children[head:len(b.children) - tail]
    at += sum(c.size + GAP[depth] for c in a.children[:head])
    for k, child in enumerate(mine):
        for s, e in differences(child, other[k], at, depth + 1) if k < len(other) else [(at, at + child.size)]:
            add(s, e)
        at += child.size + GAP[depth]
    if len(other) > len(mine):
        end = at - GAP[depth] if head or mine else at
        add(end, end)
    return out


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(k, t, next): each text with that of the next document in descending key order;
    rows without a key apart.

    The last document's next is the first.  Rows with equal keys follow each other
    by text.  Keys are cut at quantiles; the first document of each range is sent
    to the range before it too, so a range is one window and the whole order is
    never in one task.  Texts are shuffled once.  Rows without a key have no next.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    n = 4 * task_partitions(spark)
    marks = [i / n for i in range(1, n + 1)]
    found = base.agg(F.percentile_approx("k", marks, 20 * n), F.max("k")).first()
    tops = np.array(sorted({*(found[0] or []), 0 if found[1] is None else found[1]}), dtype=np.int64)    # the largest key of each range

    def ranges(keys):
        import pandas as pd
        v = keys.to_numpy(dtype=np.int64)
        own = np.searchsorted(tops, v)                             # range i ends at tops[i]
        first = tops[np.minimum(own, len(tops) - 1)] == v
        return pd.Series([[o, (o + 1) % len(tops)] if f else [o] for o, f in zip(own.tolist(), first.tolist())])

    part = F.pandas_udf(ranges, "array<long>")
    keyed = base.filter("k IS NOT NULL").withColumn("_r", part(F.col("k").cast("long")))
    rows = keyed.select("k", "t", F.posexplode("_r").alias("ahead", "range"))
    order = Window.partitionBy("range").orderBy("ahead", F.col("k").desc(), "t")
    linked = (rows.withColumn("next", F.lead("t").over(order)).filter("ahead = 0").select("k", "t", "next"))
    return linked, base.filter("k IS NULL").withColumn("next", F.lit(None).cast("string"))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, edit_spans) per row of ``docs``.

    The edited text has its last half (rounded down) replaced by as much of the
    start of the next document.  Null text counts as empty; a row without a key
    has no next document: its text stays and near_next is 0 (1 for empty text).
    A single document is its own next.  An empty table gives an empty table.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "edit_spans"]
    spans = pa.list_(pa.list_(pa.int64()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_tree = None, None                    # the next document is the next row
        for b in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for text_, after in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                own = last_tree if last == text_ else tree(text_)
                half = len(text_) // 2
                edited = text_ if after is None else text_[:len(text_) - half] + after[:half]
                new = tree(edited)
                last, last_tree = after or "", tree(after or "")
                for c, v in zip(cols, (len(text_), hashlib.sha256(edited.encode()).hexdigest(), own.hash.hex(),
                                       new.hash.hex(), likeness(own, new), likeness(own, last_tree),
                                       [list(s) for s in differences(own, new)])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:4]],
                 *[pa.array(c, pa.float64()) for c in cols[4:6]], pa.array(cols[6], spans)], names=names)

    schema = (f"k {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, edit_spans array<array<long>>")
    linked, alone = with_next(docs, key, text)
    return (linked.mapInArrow(each, schema).unionByName(alone.mapInArrow(each, schema))
            .withColumnRenamed("k", key))

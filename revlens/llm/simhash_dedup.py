"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Fingerprints are grouped into tiles by the population counts of their two
halves.  The counts of two fingerprints at Hamming distance r differ by at most
r in total, so a pair of tiles whose counts differ by more is never read.  All
other tile pairs are compared whole with numpy exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Forest, half_ball, stage, tile_pairs
from revlens.llm.components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def simhash(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash (as a signed long) of the word shingles, repeats included."""
    from xxhash import xxh64_intdigest
    words = text.translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, step = np.zeros(64, dtype=np.int64), 1 << 16
    for at in range(0, n, step):          # long texts in slices: bounded memory
        part = words[at:min(n, at + step) + shingle - 1]
        line, ends, starts, here = b" ".join(part), [], [], 0
        for w in part:
            starts.append(here)
            here += len(w)
            ends.append(here)
            here += 1
        last = ends[shingle - 1:] or ends[-1:]
        h = np.array([xxh64_intdigest(line[i:j], seed) for i, j in zip(starts, last)], dtype=np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    out = np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.int64)
    return int(out[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                 seed: int = 42) -> DataFrame:
    """(key, fp long) per row of ``docs``; null text counts as empty (fp 0)."""
    kind = docs.schema[key].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [simhash(t or b"", shingle, seed) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["k", "fp"])

    return (docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))
            .mapInArrow(each, f"k {kind}, fp long").withColumnRenamed("k", key))


def _compare(radius: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (np.sort(batch.column(c)[k].values.field(0).to_numpy(zero_copy_only=False)).view(np.uint64)
                        for c in (0, 1))
                same = batch.column(2)[k].as_py()
                nodes = a if same else np.concatenate([a, b])
                base = 0 if same else len(a)
                forest = Forest(len(nodes))
                rows = max(1, (1 << 18) // max(1, len(b)))
                for at in range(0, len(a), rows):
                    near = np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius
                    if same:
                        near &= np.arange(len(b))[None, :] > np.arange(at, min(at + rows, len(a)))[:, None]
                    for i in np.flatnonzero(near.any(axis=1)):
                        forest.join(at + int(i), base + np.flatnonzero(near[i]))
                one, two = forest.edges()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[one].view(np.int64)), pa.array(nodes[two].view(np.int64))], names=["a", "b"])
    return each


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                       radius: int = 4, seed: int = 42, capacity: int = 8192) -> DataFrame:
    """(key, fp long, component_id): fingerprints link at ``radius`` or fewer
    differing bits, component_id is the smallest key reachable.

    Equal fingerprints (exact copies) become one row before any comparison and
    come back by a join.  Null and empty texts have fingerprint 0 and link like
    any other.  Rows without a key take part in no group: component_id is null.
    Repeated rows stay repeated.  An empty table gives an empty table.
    """
    fps = stage(fingerprints(docs, key, text, shingle, seed), "simhash")
    final = groups(fps, key, radius, capacity).select("fp", "component_id")
    return fps.join(final, "fp", "left").select(
        key, "fp", F.when(F.col(key).isNotNull(), F.col("component_id")).alias("component_id"))


def groups(fps: DataFrame, key: str = "doc_id", radius: int = 4, capacity: int = 8192) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of the rows of ``fps`` (key, fp) that
    have a key: the fingerprints of a group share ``root``, their smallest; the
    smallest key of two groups may be the same."""
    reps = stage(fps.filter(F.col(key).isNotNull()).groupBy("fp").agg(F.min(key).alias("rep")), "simhash-reps")
    # cast keeps the low half unsigned: bit_count of the masked long
    cells = reps.select("fp", F.bit_count(F.shiftrightunsigned("fp", 32)).alias("hi"),
                        F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"))
    pairs = tile_pairs(cells, ("hi", "lo"), F.col("fp"), ["fp"], half_ball(radius), capacity, "simhash")
    links = pairs.mapInArrow(_compare(radius), "a long, b long")
    roots = components(links, "simhash-links")
    named = stage(roots.join(reps, roots["node"] == reps["fp"]).select("root", "fp", "rep"), "simhash-named")
    least = stage(named.groupBy("root").agg(F.min("rep").alias("least")), "simhash-least")
    grouped = named.join(least, "root").select("fp", "root", "least")
    return stage(reps.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                         F.coalesce("least", "rep").alias("component_id")),
                 "simhash-final")


def fingerprint_of(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """Fingerprint of a text beside all other columns of its row; null counts as empty."""
    def each(batches: Iterator["pd.Series"]) -> Iterator["pd.Series"]:  # noqa: F821
        import pandas as pd
        for texts in batches:
            yield pd.Series([simhash(t or b"", shingle, seed) for t in texts], dtype="int64")

    return F.pandas_udf(each, "long", F.PandasUDFType.SCALAR_ITER)(text.cast("binary"))

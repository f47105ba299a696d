"""Whitening of embeddings by a blockwise QR and a bidiagonal qd solver.

Distinct integer vectors are centred and reduced to one triangular factor: every
task folds its rows into a factor of its own, and the factors are folded in a tree.
The factor has the covariance of all rows; its leading directions come from
``bidiagonal`` on a matrix of dimension squared, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.bidiagonal import leading_components
from revlens.llm.common import stage

#: Factors folded by one task of the tree.
FAN_IN = 64
#: Rows folded into a factor at a time.
ROWS = 8192


def _pack(x: np.ndarray, off: np.ndarray) -> list[bytes]:
    """Bytes of each vector, whose entries have the smallest of 2, 4 and 8 bytes that holds them
    all: equal vectors have equal bytes, different ones differ."""
    size = np.abs(np.maximum(x, -2**63 + 1))
    top = np.maximum.reduceat(size, off[:-1]) if len(off) > 1 else size[:0]
    width = np.where(top < 2**15, 2, np.where(top < 2**31, 4, 8))
    data = {w: x.astype(f"<i{w}").tobytes() for w in np.unique(width).tolist()}
    return [data[w][w * lo:w * hi] for w, lo, hi in zip(width.tolist(), off[:-1].tolist(), off[1:].tolist())]


def _unpack(column: pa.Array, dim: int) -> np.ndarray:
    rows = column.to_pylist()
    width = np.array([len(r) // dim for r in rows])
    out = np.empty((len(rows), dim), np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), f"<i{w}").reshape(-1, dim)
    return out


def integers(v: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(v.astype(np.float64) * scale).astype(np.int64)


def whole_vectors(vectors: DataFrame, key: str, column: str, scale: int) -> DataFrame:
    """(k, dim, x): the rows whose vector has neither null nor non-finite entries, with the
    integers floor(scale * c) as bytes."""
    v = F.col(column)
    fine = v.isNotNull() & (F.size(v) > 0) & F.coalesce(
        F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))
    kind = vectors.schema[key].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            off = lists.offsets.to_numpy().astype(np.int64)
            off = off - off[0]
            packed = _pack(integers(lists.flatten().to_numpy(zero_copy_only=False), scale), off)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off).astype(np.int32)), pa.array(packed, pa.binary())],
                names=["k", "dim", "x"])

    return (vectors.select(F.col(key).alias("k"), v.alias("v"), fine.alias("fine"))
            .filter("fine").select("k", "v").mapInArrow(each, f"k {kind}, dim int, x binary"))


def vector_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension (one short row per task)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * dim
        for b in batches:
            x = _unpack(b.column(0), dim)
            n += len(x)
            # halves of 32 bits: no sum of a batch leaves 64 bits
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            s = [t + (int(h) << 32) + int(w) for t, h, w in zip(s, high, low)]
        yield pa.RecordBatch.from_pydict({"place": list(range(-1, dim)), "s": [str(n), *map(str, s)]},
                                         schema=pa.schema([("place", pa.int32()), ("s", pa.string())]))

    rows = (fit.select("x").mapInArrow(each, "place int, s string").groupBy("place")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())        # dim + 1 rows
    by = {r["place"]: int(r["s"]) for r in rows}
    return by.get(-1, 0), [by.get(i, 0) for i in range(dim)]


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - S/n in double, from the exact whole number n*x - S where it fits."""
    top = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, s), default=0)
    if top < 2**62:
        return (n * x - np.array(s, np.int64)) / n
    return np.array([[float(int(c) * n - t) / n for c, t in zip(row, s)] for row in x]).reshape(x.shape)


def deviations(x: np.ndarray, n: int, s: list[int]) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, exact; null where it leaves 64 bits."""
    top = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, s), default=0)
    if top * top * max(1, x.shape[1]) < 2**63:
        return ((n * x - np.array(s, np.int64)) ** 2).sum(1).tolist()
    whole = (sum((int(c) * n - t) ** 2 for c, t in zip(row, s)) for row in x)
    return [w if w < 2**63 else None for w in whole]


def _fold(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Triangular factor of ``r`` over ``rows``, filled up to a square."""
    out = np.linalg.qr(np.vstack([r, rows]), mode="r")
    return np.vstack([out, np.zeros((r.shape[1] - len(out), r.shape[1]))])


def triangular_factor(fit: DataFrame, dim: int, n: int, s: list[int]) -> np.ndarray:
    """The factor R of all centred rows: R'R is n times their covariance."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        r = np.zeros((dim, dim))
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                r = _fold(r, centred(_unpack(b.column(0)[at:at + ROWS], dim), n, s))
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "r": [r.tobytes()]},
                                         schema=pa.schema([("part", pa.int32()), ("r", pa.binary())]))

    fan = max(2, min(FAN_IN, 2**28 // (8 * dim * dim)))                # a task holds 256 MB of factors at most

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((dim, dim))
        for _, part in rows.sort_values("part").iterrows():
            r = _fold(r, np.frombuffer(part["r"]).reshape(dim, dim))
        return pd.DataFrame({"part": [int(rows["part"].min()) // fan], "r": [r.tobytes()]})

    factors = stage(fit.select("x").mapInArrow(each, "part int, r binary"), "whiten-factors")
    while (top := factors.agg(F.max("part")).first()[0] or 0) > 0:
        factors = stage(factors.groupBy((F.col("part") / fan).cast("int")).applyInPandas(fold, "part int, r binary"),
                        f"whiten-factors-{top}")
    only = factors.first()                                            # dim x dim, whatever the rows
    return np.frombuffer(only["r"]).reshape(dim, dim)


def identity_error(fit: DataFrame, dim: int, n: int, project) -> float:
    """Largest absolute entry of the covariance of the projected fit list, centred first, less
    the identity."""
    def passed(each, width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for b in batches:
                total += each(project(_unpack(b.column(0), dim))).ravel()
            yield pa.RecordBatch.from_pydict({"place": list(range(width)), "s": total.tolist()},
                                             schema=pa.schema([("place", pa.int32()), ("s", pa.float64())]))
        rows = fit.select("x").mapInArrow(run, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(width)
        for r in rows:
            out[r["place"]] = r["s"]
        return out / n

    k = project(np.zeros((1, dim), np.int64)).shape[1]
    mean = passed(lambda y: y.sum(0), k)
    covariance = passed(lambda y: (y - mean).T @ (y - mean), k * k).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = 4,
           scale: int = 256) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per row and component.

    Rows whose vector is null, empty or holds null or non-finite entries are dropped; a
    null key stays.  Entries count as whole numbers floor(scale * c).  Mean and
    components are those of the distinct vectors, so copies weigh nothing; every row
    of the table gets its places.  Vectors of different length are fitted apart.  There
    are at most ``components``, as many as have a positive variance: none for an
    empty table or for a single distinct vector.  Equal variances give any directions
    of their common plane, the same for all rows.  A deviation beyond 64 bits is null.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows = stage(whole_vectors(vectors, key, column, scale), "whiten-rows")
    fit = stage(rows.select("dim", "x").distinct(), "whiten-fit")
    out = None
    for dim in sorted(r[0] for r in rows.select("dim").distinct().collect()):          # one value as a rule
        of = fit.filter(F.col("dim") == dim)
        n, s = vector_sums(of, dim)
        r = triangular_factor(of, dim, n, s) / np.sqrt(n)
        values, directions = leading_components(r, min(components, dim))
        if not len(values):
            continue
        scaled, share = directions / np.sqrt(values), values / (r * r).sum()

        def project(x, n=n, s=s, scaled=scaled):
            return centred(x, n, s) @ scaled

        error = identity_error(of, dim, n, project)

        def each(batches, dim=dim, n=n, s=s, project=project, share=share, error=error):
            k = len(share)
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    x = _unpack(b.column(1)[at:at + ROWS], dim)
                    m = len(x)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0)[at:at + ROWS].take(pa.array(np.repeat(np.arange(m), k))),
                         pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                         pa.array(deviations(x, n, s), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                         pa.array(project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                        names=["k", *[c.split()[0] for c in OUT.split(", ")]])

        part = rows.filter(F.col("dim") == dim).select("k", "x").mapInArrow(each, f"k {kind}, {OUT}")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.limit(0).mapInArrow(lambda batches: iter(()), f"k {kind}, {OUT}")
    return out.withColumnRenamed("k", key)

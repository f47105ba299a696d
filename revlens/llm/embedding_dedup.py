"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= c lie within epsilon = sqrt(2 - 2c).  They are
rotated onto principal axes, sorted by their epsilon-grid cells on the leading
axes, and intervals of the sorted sequences are joined recursively: two
intervals whose bounding boxes are farther apart than epsilon are skipped.

A tile of vectors is one binary row.  Pairs of tiles come from a product of the staged
tiles with themselves, whose tasks read the tiles from files: a pair is never shuffled, so
disk grows with the vectors and not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import Forest, stage, task_partitions
from revlens.llm.components import components
from revlens.session import shuffles_dropped


def _units(e: np.ndarray) -> np.ndarray:
    """Vectors as unit vectors, scaled by the largest component first: tiny and huge vectors keep their
    direction.  The squares are added in the order of the components, whatever rows stand together."""
    flat = e / np.abs(e).max(axis=1)[:, None]
    total = np.zeros(len(e))
    for c in flat.T:
        total += c * c
    return flat / np.sqrt(total)[:, None]


def principal_axes(vectors: DataFrame, leading: int, sample: int) -> dict[int, np.ndarray]:
    """Leading principal axes by vector length, from at most ``sample`` vectors
    (smallest hashes).  They steer only what is skipped, never what links."""
    rows = vectors.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("_e").collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r[0]), []).append(r[0])
    out = {}
    for dim, e in by.items():
        v = _units(np.asarray(e, dtype=float))
        _, _, axes = np.linalg.svd(v - np.mean(v, axis=0), full_matrices=True)
        out[dim] = axes[:leading]
    return out


def ego_join(p: np.ndarray, q: np.ndarray, same: bool, eps: float, leaf: int, found) -> None:
    """Recursive join of the sorted sequences ``p`` and ``q`` (leading coordinates).

    Calls ``found(i0, i1, j0, j1)`` for every pair of intervals of at most
    ``leaf`` rows whose bounding boxes come within eps.
    """
    todo = [(0, len(p), 0, len(q))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if i0 == i1 or j0 == j1 or (same and j1 <= i0):
            continue
        a, b = p[i0:i1], q[j0:j1]
        gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
        if (gap * gap).sum() > eps * eps * (1 + 1e-9) + 1e-12:
            continue
        if i1 - i0 <= leaf and j1 - j0 <= leaf:
            found(i0, i1, j0, j1)
        elif i1 - i0 >= j1 - j0:
            m = (i0 + i1) // 2
            todo += [(i0, m, j0, j1), (m, i1, j0, j1)]
        else:
            m = (j0 + j1) // 2
            todo += [(i0, i1, j0, m), (i0, i1, m, j1)]


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a list column of equal lengths, one a row."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _placed(axes: dict[int, np.ndarray], eps: float):
    """Tasks' function: each vector with its cell on the two leading axes."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("dim").to_numpy()
            cells = np.zeros((2, len(b)), np.int32)
            for dim in np.unique(size):
                at = np.flatnonzero(size == dim)
                if dim in axes:
                    p = _units(_matrix(b.column("_e").take(pa.array(at)))) @ axes[dim][:2].T
                    cells[:p.shape[1], at] = np.floor(p / eps).T
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells[0]), pa.array(cells[1])],
                                             names=[*b.schema.names, "c0", "c1"])
    return each


TILE = "dim int, c0 int, c1 int, tile string, rep binary, copies binary, vectors binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks' function: the rows of a tile as three binary values."""
    for b in batches:
        for k in range(b.num_rows):
            rows = b.column("rows")[k].values
            cells = [rows.field(n).to_numpy(zero_copy_only=False).tobytes() for n in ("rep", "copies")]
            e = rows.field("_e").flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*(b.column(n).slice(k, 1) for n in ("dim", "c0", "c1", "tile")),
                                              *(pa.array([x], pa.binary()) for x in (*cells, e.tobytes()))],
                                             names=["dim", "c0", "c1", "tile", "rep", "copies", "vectors"])


def _tiles(units: DataFrame, axes: dict[int, np.ndarray], eps: float, capacity: int) -> DataFrame:
    """Rows ``TILE``: vectors of one cell; a cell of more than ``capacity`` vectors is dealt over several
    tiles by the hash of its members, so that no tile grows with the data."""
    schema = T.StructType([*units.schema.fields, T.StructField("c0", T.IntegerType()), T.StructField("c1", T.IntegerType())])
    placed = units.mapInArrow(_placed(axes, eps), schema)
    keys = ["dim", "c0", "c1"]
    cells = stage(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "ego-cells")
    chunk = F.pmod(F.xxhash64("rep"), F.ceil(F.col("_n") / capacity)).cast("int")
    rows = placed.join(cells, keys).withColumn("_chunk", chunk)
    # a given number of files: the product of the tiles has a task for each two of them
    tasks = max(task_partitions(units.sparkSession), units.sparkSession.sparkContext.defaultParallelism)
    packed = (rows.repartition(tasks, *keys, "_chunk").groupBy(*keys, "_chunk")
              .agg(F.collect_list(F.struct("rep", "copies", "_e")).alias("rows"))
              .select(*keys, F.concat_ws(":", *keys, "_chunk").alias("tile"), "rows"))
    return stage(packed.mapInArrow(_packed, TILE), "ego-tiles")


def _pairs(tiles: DataFrame) -> DataFrame:
    """Every two tiles of equal or neighbouring cells, once: columns a and b, in the tasks that read them."""
    a, b = (tiles.select(F.struct(*tiles.columns).alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("dim", "c0", "c1", "tile")])
            for n in ("a", "b"))
    # a difference, not an equality: by an equality the tiles would be shuffled
    near = ((F.col("dim_a") - F.col("dim_b") == 0) & (F.abs(F.col("c0_a") - F.col("c0_b")) <= 1)
            & (F.abs(F.col("c1_a") - F.col("c1_b")) <= 1) & (F.col("tile_a") <= F.col("tile_b")))
    return a.join(b.hint("shuffle_replicate_nl"), near).select("a", "b")


def _join(threshold: float, axes: dict[int, np.ndarray], leading: int, leaf: int, kind: str):
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    held: dict = {}                                  # the tile last read on the left

    def load(tile: dict):
        rep, copies = (np.frombuffer(tile[n], np.int64) for n in ("rep", "copies"))
        u = _units(np.frombuffer(tile["vectors"], kind).astype(float).reshape(len(rep), -1))
        basis = axes.get(u.shape[1], np.eye(u.shape[1])[:leading])
        p = u @ basis.T
        order = np.lexsort(np.floor(p / max(eps, 1e-9)).T[::-1])     # epsilon grid order
        return u[order], p[order], rep[order], copies[order]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = batch.column(0)[k], batch.column(1)[k]
                name, other = a["tile"].as_py(), b["tile"].as_py()
                if name not in held:
                    held.clear()
                    held[name] = load(a.as_py())
                same = name == other
                ua, pa_, ra, ca = held[name]
                ub, pb, rb, cb = (ua, pa_, ra, ca) if same else load(b.as_py())
                base = 0 if same else len(ra)
                rep = ra if same else np.concatenate([ra, rb])
                forest, links = Forest(len(rep)), np.zeros(len(rep), dtype=np.int64)
                fa, fb = ua.astype(np.float32), ub.astype(np.float32)
                least = threshold - (ua.shape[1] + 8) * 2.0 ** -22    # more than single precision can be off

                def found(i0, i1, j0, j1):
                    if not (fa[i0:i1] @ fb[j0:j1].T >= least).any():
                        return
                    near = ua[i0:i1] @ ub[j0:j1].T >= threshold
                    if same:
                        near &= np.arange(j0, j1)[None, :] > np.arange(i0, i1)[:, None]
                    if near.any():
                        links[i0:i1] += near @ cb[j0:j1]
                        links[base + j0:base + j1] += ca[i0:i1] @ near
                        for i in np.flatnonzero(near.any(axis=1)):
                            forest.join(i0 + int(i), base + j0 + np.flatnonzero(near[i]))

                ego_join(pa_, pb, same, eps, leaf, found)
                at, to = forest.edges()
                n = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([rep[n], rep[at]])),
                     pa.array(np.concatenate([links[n], np.zeros(len(at), dtype=np.int64)])),
                     pa.array([None] * len(n) + rep[to].tolist(), pa.int64())], names=["a", "links", "b"])
    return each


def cosine_components(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
                      threshold: float = 0.95, leading: int = 8, capacity: int = 2048, leaf: int = 256,
                      sample: int = 4096) -> DataFrame:
    """(key, n_links, component_id, kept): vectors link at cosine >= threshold.

    One row per input row.  Equal vectors are joined once and counted with their
    copies.  Null, empty and zero vectors and vectors with null or non-finite
    components link with nothing; vectors of different length never link.  A row
    without a key links with nothing and has a null component.  Different vectors
    under one key pool their links and share its component.  An empty table gives
    an empty table.
    """
    with shuffles_dropped(vectors.sparkSession):
        return _components(vectors, key, column, threshold, leading, capacity, leaf, sample)


def _components(vectors: DataFrame, key: str, column: str, threshold: float, leading: int, capacity: int, leaf: int,
                sample: int) -> DataFrame:
    e, x = F.col(column), F.col("_e")
    kind = vectors.schema[key].dataType
    single = vectors.schema[column].dataType.elementType.typeName() == "float"
    # adding zero: -0 is 0, as it is where vectors are compared
    base = vectors.select(F.col(key).cast("long").alias("_k"),
                          F.transform(e.cast(f"array<{'float' if single else 'double'}>"),
                                      lambda c: c + F.lit(0.0).cast("float" if single else "double")).alias("_e"))
    fine = (F.col("_k").isNotNull() & x.isNotNull() & (F.size(x) > 0)
            & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))),
                         F.lit(False))
            & F.coalesce(F.exists(x, lambda c: c != 0), F.lit(False)))
    rows = stage(base.select("_k", F.when(fine, x).alias("_e")), "ego-rows")
    units = stage(rows.filter("_e IS NOT NULL").groupBy("_e")
                  .agg(F.min("_k").alias("rep"), F.count(F.lit(1)).alias("copies"))
                  .withColumn("dim", F.size("_e")), "ego-units")
    axes = principal_axes(units, leading, sample)
    eps = float(np.sqrt(max(1e-18, 2 - 2 * threshold)))
    tiles = _tiles(units, axes, eps, capacity)
    out = stage(_pairs(tiles).mapInArrow(_join(threshold, axes, leading, leaf, "float32" if single else "float64"),
                                         "a long, links long, b long"), "ego-links")
    links = out.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("_l"))
    roots = components(out.filter("b IS NOT NULL").select("a", "b"), "ego-comp")
    named = stage(units.select(F.col("rep").alias("node")).distinct().join(roots, "node", "left")
                  .select("node", F.coalesce("root", "node").alias("component_id")), "ego-named")
    # a vector's digest stands for it: the vectors themselves are shuffled once
    digest = F.unhex(F.sha2(F.col("_e").cast("string"), 256)).alias("_d")
    info = stage(units.select(digest, F.col("rep").alias("node"), "copies")
                 .join(links, F.col("node") == F.col("a"), "left").join(named, "node")
                 .select("_d", (F.coalesce("_l", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
                 "ego-info")
    linked = rows.filter("_e IS NOT NULL").select("_k", digest).join(info, "_d").select("_k", "n_links", "component_id")
    alone = rows.filter("_e IS NULL").select("_k", F.lit(0).cast("long").alias("n_links"),
                                             F.col("_k").alias("component_id"))
    return (linked.unionByName(alone)
            .select(F.col("_k").cast(kind).alias(key), F.col("n_links").cast("long"), "component_id")
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True))))

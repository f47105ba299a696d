"""Skip-gram word vectors with negative samples, trained in the tasks (M1).

The method is the reference's (skip-gram, five negative samples a pair).  The two
matrices (words x dim) are tables, never whole on the driver or in one task:

* The reviews are dealt into blocks of bounded size.  A block's tokens become numbers of
  its own dictionary once; the vocabulary is the sum of the blocks' counts.
* In each pass a block meets the vectors of its own words, trains them on all its tokens and
  gives them back; the rows of a word meet, and their mean goes to the blocks of the next pass
  (Spark's own trainer averages its partitions in the same way, on the driver).
* Between passes vectors travel as half floats; those of the last pass are single floats.

A context at distance d of a word counts with (window + 1 - d) / window, the mean of the randomly
shortened window.  Negative samples come from the words of the block, by count ** 0.75.
The blocks, not the cluster, determine the result; which review is in which block follows the
order in which Spark reads them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffles_dropped

SHEET = 1024                # tokens in a row of a block
CHUNK, NOISE = 16, 16       # words that share their negative samples, and how many these are
BATCH = 512                 # words between two updates of the vectors
MOST = 4                    # uses of a word in a batch that count in full
NEGATIVE, RATE = 5, 0.025   # negative samples of a pair, learning rate at the start
ENCODED = "block int, seq int, word string, local int, n long, data binary"
TRAINED = "id long, block int, local int, data binary"


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """The matrix of equally long binary values."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(column), -1).view(kind)


def _pressed(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix, compressed: most numbers of a text are small."""
    return pa.array([pa.compress(np.ascontiguousarray(r), codec="zstd", asbytes=True) for r in rows], pa.binary())


def _unpressed(column: pa.Array, size: int) -> np.ndarray:
    """The numbers of compressed rows of ``size`` numbers, one after the other."""
    out = np.empty((len(column), size), np.int32)
    for i, r in enumerate(column):
        out[i] = np.frombuffer(pa.decompress(r.as_buffer(), size * 4, codec="zstd"), np.int32)
    return out.ravel()


# ----------------------------------------------------------------- blocks
def _encoder(window: int):
    """Tasks' function: the token lists of a block as rows of numbers, and its words with their uses.

    Number 0 stands ``window`` times between two lists, so no window reaches over an end."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, lists, sizes = TaskContext.get().partitionId(), [], []
        for b in batches:
            column = b.column(0)
            if not len(column):
                continue
            sizes.append(np.diff(column.offsets.to_numpy()))
            lists.append(column.flatten().cast(pa.string()).dictionary_encode())
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int32)
        if not size.sum():
            return
        whole = pa.chunked_array(lists).unify_dictionaries()
        words = whole.chunk(0).dictionary
        out = np.zeros(-(-(int(size.sum()) + window * len(size)) // SHEET) * SHEET, np.int32)
        at = 0
        for n, c in zip(sizes, whole.chunks):
            ids = c.indices.to_numpy()
            out[at + np.arange(len(ids)) + np.repeat(np.arange(len(n)) * window, n)] = ids + 1
            at += len(ids) + window * len(n)
        uses = np.bincount(out, minlength=len(words) + 1)[1:]
        rows = out.reshape(-1, SHEET)
        for s in range(0, len(rows), 1000):
            r, n = rows[s:s + 1000], len(rows[s:s + 1000])
            yield _encoded(block, np.arange(s, s + n), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()),
                           pa.nulls(n, pa.int64()), _pressed(r))
        for s in range(0, len(words), 10_000):
            w = words[s:s + 10_000]
            yield _encoded(block, np.full(len(w), -1), w, pa.array(np.arange(s + 1, s + 1 + len(w)), pa.int32()),
                           pa.array(uses[s:s + len(w)], pa.int64()), pa.nulls(len(w), pa.binary()))
    return encode


def _encoded(block: int, seq: np.ndarray, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(seq), block), pa.int32()), pa.array(seq, pa.int32()), *columns],
                                      names=["block", "seq", "word", "local", "n", "data"])


# ----------------------------------------------------------------- one pass
def _first_vectors(digests: np.ndarray, dim: int) -> np.ndarray:
    """Start of each word, uniform in +-1/(2 dim), from its 64-bit digest alone: all blocks begin alike."""
    out = np.empty((len(digests), dim), np.float32)
    for i in range(dim):
        z = digests + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = (((z ^ (z >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / dim
    return out


def _add(matrix: np.ndarray, rows: np.ndarray, steps: np.ndarray) -> None:
    """Add to each row the sum of its steps; more than ``MOST`` of them weigh as many as ``MOST``, since
    all of a batch are taken from the same place."""
    order = np.argsort(rows, kind="stable")
    ranked = rows.take(order)
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    n = np.diff(first, append=len(ranked))
    total = steps.take(order.take(first), axis=0)
    for k in range(1, MOST):
        more = np.flatnonzero(n > k)
        total[more] += steps.take(order.take(first.take(more) + k), axis=0)
    for i in np.flatnonzero(n > MOST):
        total[i] = steps.take(order[first[i]:first[i] + n[i]], axis=0).sum(axis=0) * np.float32(MOST / n[i])
    own = ranked.take(first)
    total += matrix.take(own, axis=0)
    matrix[own] = total


def train_block(ids: np.ndarray, x: np.ndarray, y: np.ndarray, window: int, rate: tuple[float, float],
                rng: np.random.Generator) -> None:
    """One pass over the numbered tokens ``ids`` of a block (0: an end); ``x`` (words) and ``y`` (as
    neighbours) change in place, their row 0 stays zero.  ``rate``: learning rate at the start and the end.

    The words of a chunk and its negative samples meet all contexts of the chunk in one product."""
    dim, width = x.shape[1], CHUNK + 2 * window
    if not ids.any():
        return
    share = np.cumsum(np.bincount(ids, minlength=len(x))[1:] ** 0.75)
    slots = max(1 << 20, 4 * len(x))
    noise = (1 + np.searchsorted(share, (np.arange(slots) + rng.random()) / slots * share[-1])).clip(max=len(x) - 1).astype(np.int32)
    apart = np.abs(np.arange(width)[:, None] - window - np.arange(CHUNK)[None, :])
    band = np.where((apart > 0) & (apart <= window), (window + 1 - apart) / window, 0).astype(np.float32)
    per_noise = np.float32(NEGATIVE / NOISE)
    weight = np.concatenate((band, np.repeat(band.sum(1, keepdims=True) * per_noise, NOISE, 1)), 1)
    wanted = np.zeros((width, CHUNK + NOISE), np.float32)
    wanted[:, :CHUNK] = 1
    batches = -(-len(ids) // BATCH)
    ids = np.concatenate((np.zeros(window, ids.dtype), ids, np.zeros(batches * BATCH - len(ids) + window, ids.dtype)))
    chunks = BATCH // CHUNK
    for k in range(batches):
        at = np.float32(rate[0] + (rate[1] - rate[0]) * k / batches)
        near = ids[k * BATCH:(k + 1) * BATCH + 2 * window]
        middle = near[window:window + BATCH].reshape(chunks, CHUNK)
        out = np.concatenate((middle, noise[rng.integers(0, slots, (chunks, NOISE), dtype=np.int32)]), 1)
        u, v = x.take(near, axis=0), y.take(out, axis=0)
        u3 = as_strided(u, (chunks, width, dim), (CHUNK * u.strides[0], *u.strides))
        f = np.matmul(u3, v.transpose(0, 2, 1))
        np.clip(f, -15, 15, out=f)
        np.negative(f, out=f)
        np.exp(f, out=f)
        f += 1
        np.reciprocal(f, out=f)
        np.subtract(wanted, f, out=f)
        if near.all():
            f *= weight * at
        else:                                                       # ends: no pair with them
            known = (near > 0).astype(np.float32)
            k3 = as_strided(known, (chunks, width), (CHUNK * known.strides[0], known.strides[0]))[:, :, None]
            pairs = band * k3 * (middle > 0)[:, None, :]
            f[:, :, :CHUNK] *= pairs
            f[:, :, CHUNK:] *= pairs.sum(2, keepdims=True) * per_noise
            f *= at
        du, dv = np.matmul(f, v), np.matmul(f.transpose(0, 2, 1), u3)
        steps = np.zeros((chunks * CHUNK + 2 * window, dim), np.float32)
        steps[:BATCH] = du[:, :CHUNK].reshape(-1, dim)
        for j in range(chunks):                                     # contexts shared with the chunks that follow
            steps[(j + 1) * CHUNK:(j + 1) * CHUNK + 2 * window] += du[j, CHUNK:]
        _add(x, near, steps)
        _add(y, out.ravel(), dv.reshape(-1, dim))


def _blocks(batches: Iterator[pa.RecordBatch]):
    """(block, its rows in their order) of rows sorted by block."""
    block, rows = None, []
    for b in batches:
        of = b.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if e > s:
                if block is not None and of[s] != block:
                    yield int(block), rows
                    rows = []
                block = of[s]
                rows.append(b.slice(s, e - s))
    if block is not None:
        yield int(block), rows


def _trainer(dim: int, window: int, seed: int, k: int, passes: int):
    """Tasks' function of pass ``k``: rows of a block (its words, then its tokens) to its trained words."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches):
            local, word, data, sheets = [], [], [], []
            while rows:
                b = rows.pop(0)
                n = int((b.column("seq").to_numpy() < 0).sum())
                if n:
                    local.append(b.column("local").slice(0, n).to_numpy())
                    word.append(b.column("id").slice(0, n).to_numpy())
                    data.append(_matrix(b.column("data").slice(0, n), np.float16 if k else np.uint64).copy())
                if n < len(b):
                    sheets.append(_unpressed(b.column("data").slice(n), SHEET))
            if not word:
                continue
            local, word = np.concatenate(local), np.concatenate(word)
            order = np.argsort(local)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(1, len(order) + 1)
            local, word = local[order], word[order]
            x, y = np.zeros((len(order) + 1, dim), np.float32), np.zeros((len(order) + 1, dim), np.float32)
            s = 0
            for i, d in enumerate(data):
                at = place[s:s + len(d)]
                if k:
                    x[at], y[at] = d[:, :dim], d[:, dim:]
                else:
                    x[at] = _first_vectors(d[:, 0], dim)
                data[i], s = None, s + len(d)
            known = np.zeros(max(int(local[-1]), max((int(t.max()) for t in sheets), default=0)) + 1, np.int32)
            known[local] = np.arange(1, len(local) + 1)
            for i, t in enumerate(sheets):                          # words of too few uses leave the text
                sheets[i] = known[t[(t == 0) | (known[t] > 0)]]
            ids = np.concatenate(sheets) if sheets else np.zeros(0, np.int32)
            del sheets
            start, end = (RATE * max(1 - p / passes, 1e-4) for p in (k, k + 1))
            train_block(ids, x, y, window, (start, end), np.random.default_rng([seed & 0xFFFFFFFF, k, block]))
            for s in range(1, len(x), 10_000):
                e = min(s + 10_000, len(x))
                d = x[s:e] if k + 1 == passes else np.concatenate((x[s:e], y[s:e]), 1).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array(word[s - 1:e - 1], pa.int64()),
                                                  pa.array(np.full(e - s, block), pa.int32()),
                                                  pa.array(local[s - 1:e - 1], pa.int32()), _binary(d)],
                                                 names=["id", "block", "local", "data"])
    return train


def _averager(last: bool):
    """Tasks' function: the mean of the vectors of each word; all rows of a word are in one task."""
    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, block, local, data = [], [], [], []
        for b in batches:
            if len(b):
                word.append(b.column("id").to_numpy().copy())
                block.append(b.column("block").to_numpy().copy())
                local.append(b.column("local").to_numpy().copy())
                data.append(_matrix(b.column("data"), np.float32 if last else np.float16).copy())
        if not word:
            return
        word, block, local, data = (np.concatenate(c) for c in (word, block, local, data))
        order = np.lexsort((block, word))
        word, block, local = word[order], block[order], local[order]
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        n = np.diff(first, append=len(word))
        ends = np.append(first, len(word))
        for s in range(0, len(first), 10_000):
            f, m = first[s:s + 10_000], n[s:s + 10_000]
            mean = data[order[f]].astype(np.float32)
            for k in range(1, int(m.max())):
                more = np.flatnonzero(m > k)
                mean[more] += data[order[f[more] + k]]
            mean /= m[:, None].astype(np.float32)
            if last:
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * mean.shape[1], pa.int32()), pa.array(mean.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(word[f]), flat], names=["id", "vector"])
                continue
            e = pa.array(ends[s:s + len(f) + 1] - f[0], pa.int32())
            span = slice(f[0], ends[s + len(f)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[f]), pa.ListArray.from_arrays(e, pa.array(block[span], pa.int32())),
                 pa.ListArray.from_arrays(e, pa.array(local[span], pa.int32())), _binary(mean.astype(np.float16))],
                names=["id", "block", "local", "data"])
    return average


# ----------------------------------------------------------------- training
def train(reviews: DataFrame, tokens: str, dim: int, window: int, min_count: int, seed: int, blocks: int,
          passes: int, max_sentence: int, block_tokens: int) -> DataFrame:
    """(word, vector array<float>) of every word of ``min_count`` or more uses.

    There are ``blocks`` blocks, or as many as hold ``block_tokens`` tokens each: a task's memory is
    bounded by the block, and their number grows with the tokens."""
    with shuffles_dropped(reviews.sparkSession):
        return _train(reviews, tokens, dim, window, min_count, seed, blocks, passes, max_sentence, block_tokens)


def _train(reviews: DataFrame, tokens: str, dim: int, window: int, min_count: int, seed: int, blocks: int,
           passes: int, max_sentence: int, block_tokens: int) -> DataFrame:
    from ..session import checkpoint_dir
    from ..sources.documents import _stage
    spark = reviews.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/staged/vectors-{uuid.uuid4().hex}"
    lists = reviews.select(F.array_compact(tokens).alias("t")).where(F.size("t") > 0)
    total = lists.agg(F.sum(F.size("t").cast("long"))).first()[0]
    if not total:
        raise ValueError("no tokens to train on")
    blocks = max(blocks, -(-total // block_tokens))
    pieces = lists.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("t"), F.lit(max_sentence)),
                                                lambda i: F.slice("t", i, max_sentence))).alias("t"))
    coded = _stage(pieces.repartition(blocks).mapInArrow(_encoder(window), ENCODED), "coded-tokens")
    sheets = coded.where("seq >= 0").select("block", "seq", F.lit(0).alias("local"), F.lit(0).cast("long").alias("id"), "data")
    digest = F.unhex(F.lpad(F.hex(F.xxhash64(F.lit(seed), "word")), 16, "0"))
    words = _stage(coded.where("seq < 0").groupBy("word")
                        .agg(F.sum("n").alias("n"), F.collect_list(F.struct("block", "local")).alias("p"))
                        .where(F.col("n") >= min_count)
                        .select(F.monotonically_increasing_id().alias("id"), "word", "p.block", "p.local", digest.alias("data")),
                   "vocabulary")
    if words.isEmpty():
        raise ValueError(f"no word of {min_count} or more uses")
    at = words
    for k in range(passes):
        rows = (at.select("id", "data", F.explode(F.arrays_zip("block", "local")).alias("p"))
                  .select("p.block", F.lit(-1).alias("seq"), "p.local", "id", "data"))
        trained = (rows.unionByName(sheets).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "seq")
                       .mapInArrow(_trainer(dim, window, seed, k, passes), TRAINED))
        last = k + 1 == passes
        means = trained.repartition(4 * blocks, "id").mapInArrow(
            _averager(last), "id long, vector array<float>" if last else "id long, block array<int>, local array<int>, data binary")
        path = f"{folder}-{k % 2}"                                  # over the vectors of the pass before the last
        means.write.mode("overwrite").parquet(path)
        at = spark.read.schema(means.schema).parquet(path)
    return words.select("id", "word").join(at, "id").select("word", "vector")

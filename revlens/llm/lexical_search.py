"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like size lie in blocks.  A block is a matrix of bits, one row for each
place of the signature and one column for each document: a term sets the bits of
``PROBES`` rows in the columns of its documents, once for every level of
``LEVELS`` that its frequency reaches.  The rows of a term, and-ed, are a bitmap that
holds all documents with the term at that frequency, and a few more.  So the level
up to which a document's bits are set bounds the term's part of its score from above,
and the sums of these parts bound the scores.

A search takes the documents with the highest bounds, scores them exactly from their
texts, and takes the k-th best as the bar of a query; then every document whose bound
reaches the bar is scored exactly.  None that could be among the best is left out.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revlens.llm.common import stage

#: Everything but letters, digits and bytes of other scripts ends a term; A-Z are lowered.
TERMS = bytes((b if b >= 128 or chr(b).isalnum() else 32) for b in range(256)).lower()
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128], np.int64)
PROBES = 4
#: Rows of a signature for each entry that the largest document of a block may have.
ROWS_PER_ENTRY = 12
LEAST_CLASS = 5
#: Bits of a block and documents of it, at most.
BLOCK_BITS, BLOCK_DOCS = 1 << 26, 8192
UNIT = 1_000_000_000
BLOCK = ("rows int, bits binary, keys array<long>, hashes array<long>, sizes array<long>, "
         "terms array<string>, dfs array<int>")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def probes(hashes: np.ndarray, level: int, rows: int) -> np.ndarray:
    """(len(hashes), PROBES): the rows of terms at a level."""
    with np.errstate(over="ignore"):
        h = hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        one, two = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        return np.stack([(one + np.uint64(i) * two) % np.uint64(rows) for i in range(PROBES)], axis=1).astype(np.int64)


def hashes_of(terms: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


class _Block:
    """Documents of one class of sizes, until their block is full."""

    def __init__(self, size_class: int):
        self.rows = ROWS_PER_ENTRY << size_class
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BITS // self.rows // 8 * 8))
        self.start()

    def start(self) -> None:
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.keys, self.hashes, self.sizes, self.ids, self.tfs = [], [], [], [], []

    def add(self, key, text_hash, size: int, counts: Counter, tfs: np.ndarray) -> None:
        self.keys.append(key)
        self.hashes.append(text_hash)
        self.sizes.append(size)
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, counts), np.int32, len(counts)))
        self.tfs.append(tfs)

    def flush(self) -> tuple:
        ids, tfs = np.concatenate(self.ids), np.concatenate(self.tfs)
        doc = np.repeat(np.arange(len(self.ids)), [len(i) for i in self.ids])
        terms = list(self.vocabulary)
        hashes, df = hashes_of(terms), np.bincount(ids, minlength=len(terms))
        grid = np.zeros((self.rows, -(-len(self.keys) // 8) * 8), bool)
        for level, least in enumerate(LEVELS.tolist()):
            of = np.flatnonzero(tfs >= least) if level else np.arange(len(ids))
            if not len(of):
                break
            places = probes(hashes, level, self.rows)
            for i in range(PROBES):
                grid[places[ids[of], i], doc[of]] = True
        out = (self.rows, np.packbits(grid, axis=1).tobytes(), self.keys, self.hashes, self.sizes,
               [t.decode() for t in terms], df.tolist())
        self.start()
        return out


def signature_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The blocks of all documents that have a term, staged.

    Every document is in one block, found by its key and the hash of its text.  Null
    and empty texts have no terms and are in none.  Each block also lists its terms with
    the exact number of its documents that hold them.
    """
    def record(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          names=[c.split()[0] for c in BLOCK.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        for b in batches:
            for k, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                words = terms_of(t.as_buffer().to_pybytes())
                if not words:
                    continue
                counts = Counter(words)
                tfs = np.fromiter(counts.values(), np.int64, len(counts))
                entries = int(np.searchsorted(LEVELS, tfs, "right").sum())
                size = max(LEAST_CLASS, (entries - 1).bit_length())
                block = blocks.get(size) or blocks.setdefault(size, _Block(size))
                block.add(k, h, len(words), counts, tfs)
                if len(block.keys) == block.room:
                    yield record([block.flush()])
        for block in blocks.values():
            if block.keys:
                yield record([block.flush()])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("h"),
                       F.col(text).cast("binary").alias("t")).filter(F.octet_length("t") > 0)
    return stage(rows.mapInArrow(each, BLOCK), "search-blocks")


class Queries:
    """The terms of some queries, and once the corpus is counted their weights."""

    def __init__(self, names: list, texts: list[set[bytes]]):
        self.names = names
        words = sorted(set().union(*texts)) if texts else []
        self.place = {t: i for i, t in enumerate(words)}
        self.hashes = hashes_of(words)
        pairs = sorted((self.place[t], q) for q, terms in enumerate(texts) for t in terms)
        self.query = np.array([q for _, q in pairs], np.int64)
        self.first = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(words) + 1))
        self.texts = [[self.place[t] for t in sorted(terms)] for terms in texts]
        self.weight, self.docs, self.words = np.zeros(len(words), np.int64), 0, 0

    def weigh(self, docs: int, words: int, df: dict[int, int]) -> None:
        self.docs, self.words = docs, words
        for term, n in df.items():
            self.weight[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1)))

    def length_part(self, sizes: np.ndarray) -> np.ndarray:
        return 8 * (10 + (90 * sizes * self.docs) // self.words)


def bounds(block: dict, queries: Queries) -> np.ndarray:
    """(queries, documents): an upper bound of every score in a block."""
    n, rows = len(block["keys"]), block["rows"]
    bits = np.frombuffer(block["bits"], np.uint8).reshape(rows, -1)
    held = pc.index_in(pa.array([t.decode() for t in queries.place]), value_set=pa.array(block["terms"], pa.string()))
    terms = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False) & (queries.weight > 0))
    out = np.zeros(len(queries.names) * n)
    fixed = queries.length_part(np.array(block["sizes"], np.int64))
    for at in range(0, len(terms), 512):                              # 512 bitmaps at a time
        part = terms[at:at + 512]
        place = probes(queries.hashes[part], 0, rows)
        maps = bits[place[:, 0]]
        for i in range(1, PROBES):
            maps &= bits[place[:, i]]
        which, doc = np.nonzero(np.unpackbits(maps, axis=1, count=n))
        level, open_ = np.zeros(len(doc), np.int64), np.arange(len(doc))
        for step in range(1, len(LEVELS)):                            # up to the last level whose bits are set
            place = probes(queries.hashes[part], step, rows)[which[open_]]
            column = doc[open_]
            there = bits[place[:, 0], column >> 3]
            for i in range(1, PROBES):
                there = there & bits[place[:, i], column >> 3]
            open_ = open_[(there >> (7 - (column & 7)).astype(np.uint8)) & 1 == 1]
            level[open_] = step
            if not len(open_):
                break
        top = np.append(LEVELS[1:] - 1, 0)[level]                     # the highest frequency of the level
        share = np.where(top > 0, (UNIT * top) // np.maximum(1000 * top + fixed[doc], 1), UNIT // 1000)
        value = (queries.weight[part][which] * share).astype(np.float64)   # whole numbers below 2^53: exact
        term = part[which]
        times = queries.first[term + 1] - queries.first[term]
        end = np.cumsum(times)
        use = np.repeat(queries.first[term] - (end - times), times) + np.arange(int(end[-1]) if len(end) else 0)
        out += np.bincount(queries.query[use] * n + np.repeat(doc, times), weights=np.repeat(value, times),
                           minlength=len(out))
    return out.reshape(len(queries.names), n)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {name: b.column(j)[i].as_py() for j, name in enumerate(b.schema.names)}


FOUND = "q int, k long, h long, bound long"


def bounded(index: DataFrame, queries, least: np.ndarray | None, k: int) -> DataFrame:
    """(q, k, h, bound): the documents whose bound reaches ``least`` of a query, or the k
    highest bounds of each block if it is None."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = queries.value
        for block in _blocks(batches):
            u = bounds(block, held)
            if least is None:
                if u.shape[1] > k:
                    bar = np.partition(u, -k, axis=1)[:, -k]
                    over = u >= np.maximum(bar, 1)[:, None]
                    over &= np.cumsum(over, axis=1) <= 4 * k            # copies of one text tie
                else:
                    over = u >= 1
            else:
                over = u >= np.maximum(least, 1)[:, None]
            q, doc = np.nonzero(over)
            keys = pa.array(block["keys"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), keys.take(pa.array(doc)),
                 pa.array(np.array(block["hashes"], np.int64)[doc]), pa.array(u[q, doc].astype(np.int64))],
                names=["q", "k", "h", "bound"])

    return index.select("rows", "bits", "keys", "hashes", "sizes", "terms").mapInArrow(each, FOUND)


def exact(docs: DataFrame, found: DataFrame, queries, key: str, text: str, broadcast_rows: int) -> DataFrame:
    """(q, k, score): exact scores of the pairs ``found``, one for each row of ``docs``."""
    pairs = found.groupBy("k", "h").agg(F.collect_set("q").alias("qs"))      # at most the queries of a pass
    pairs = stage(pairs.withColumnsRenamed({"k": "pk", "h": "ph"}), "search-pairs")
    size = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("qs")).alias("m")).first()
    if size["n"] + (size["m"] or 0) <= broadcast_rows:                       # checked: some tens of bytes each
        pairs = F.broadcast(pairs)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("h"),
                       F.col(text).cast("binary").alias("t")).filter(F.octet_length("t") > 0)
    joined = rows.join(pairs, F.col("k").eqNullSafe(F.col("pk")) & (F.col("h") == F.col("ph")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = queries.value
        place = held.place
        for b in batches:
            out_q, out_row, out_s = [], [], []
            for i, (t, qs) in enumerate(zip(b.column(1), b.column(2).to_pylist())):
                words = terms_of(t.as_buffer().to_pybytes())
                tf = Counter(p for w in words if (p := place.get(w)) is not None)
                fixed = 8 * (10 + (90 * len(words) * held.docs) // held.words)
                part = {p: int(held.weight[p]) * (UNIT * n // (1000 * n + fixed)) for p, n in tf.items()}
                for q in qs:
                    score = sum(part.get(p, 0) for p in held.texts[q])
                    if score > 0:
                        out_q.append(q)
                        out_row.append(i)
                        out_s.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_q, pa.int32()), b.column(0).take(pa.array(out_row, pa.int64())),
                 pa.array(out_s, pa.int64())], names=["q", "k", "score"])

    return joined.select("k", "t", "qs").mapInArrow(each, "q int, k long, score long")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("k").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def query_parts(items: DataFrame, item: str, text: str, limit: int) -> Iterator[Queries]:
    """The queries in passes of at most about ``limit`` bytes of text: what a pass sends to the
    tasks is bounded however many queries there are.  Rows of one item are one query."""
    names, texts, size = [], [], 0
    rows = items.select(F.col(item).alias("i"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    for r in rows.orderBy("i").toLocalIterator():
        if names and names[-1] == r["i"]:
            texts[-1] |= set(terms_of(bytes(r["t"])))
            size += len(r["t"])
            continue
        if names and size > limit:
            yield Queries(names, texts)
            names, texts, size = [], [], 0
        names.append(r["i"])
        texts.append(set(terms_of(bytes(r["t"]))))
        size += len(r["t"])
    if names:
        yield Queries(names, texts)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item: str = "item_id", item_text: str = "text", pass_bytes: int = 1_000_000,
           broadcast_rows: int = 2_000_000) -> DataFrame:
    """(item, rank, key, score): the ``k`` highest-scoring documents of each item.

    Terms, weights and scores are whole-number BM25 as in the contract of the query.
    Equal scores go by ascending key, null keys last; only scores above 0 are returned,
    so an item with null or empty text, or whose terms occur nowhere, has no rows, and
    empty tables give none.  Rows of one item are one query; a null item is one too.
    Repeated documents are ranked one by one.
    """
    spark = docs.sparkSession
    index = signature_index(docs, key, text)
    total = index.select(F.size("keys").alias("n"), F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
                         .alias("l")).agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    kind = items.schema[item].dataType
    out = None
    for queries in query_parts(items, item, item_text, pass_bytes) if total["n"] else ():
        words = [t.decode() for t in queries.place]

        def counted(batches, words=words):
            wanted = pa.array(words, pa.string())
            for b in batches:
                for i in range(b.num_rows):
                    at = pc.index_in(wanted, value_set=b.column(0)[i].values)
                    of = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                    df = b.column(1)[i].values.take(at.filter(at.is_valid()))
                    yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), df.cast(pa.int64())],
                                                     names=["term", "df"])

        df = (index.select("terms", "dfs").mapInArrow(counted, "term int, df long").groupBy("term")
              .agg(F.sum("df").alias("df")).collect())                # the terms of a pass
        queries.weigh(int(total["n"]), int(total["l"]), {r["term"]: r["df"] for r in df})
        held = spark.sparkContext.broadcast(queries)
        by_bound = Window.partitionBy("q").orderBy(F.col("bound").desc(), F.col("k").asc_nulls_last(), "h")
        seeds = (bounded(index, held, None, k).withColumn("r", F.row_number().over(by_bound))
                 .filter(F.col("r") <= k).select("q", "k", "h"))
        bars = (_ranked(exact(docs, seeds, held, key, text, broadcast_rows), k).filter(F.col("rank") == k)
                .select("q", "score").collect())                      # one number a query
        least = np.zeros(len(queries.names), np.int64)
        for r in bars:
            least[r["q"]] = r["score"]
        found = stage(bounded(index, held, least, k).select("q", "k", "h"), "search-found")
        best = _ranked(exact(docs, found, held, key, text, broadcast_rows), k)
        names = spark.createDataFrame([(i, n) for i, n in enumerate(queries.names)],
                                      f"q int, item {kind.simpleString()}")
        part = best.join(names, "q").select(F.col("item").alias(item), F.col("rank").cast("int").alias("rank"),
                                            F.col("k").alias(key), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"{item} {kind.simpleString()}, rank int, {key} long, score long")
    return out

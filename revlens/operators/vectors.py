"""Word vectors, review/product vectors and representative reviews.

* Word vectors are trained by ``skipgram``: vocabulary and matrices (words x dim
  floats) are tables, a task holds the words of its block.  The number of blocks
  does not depend on the cluster.
* A review vector is the mean of its *in-vocabulary* token vectors (tokens
  joined to the vocabulary table); ``Word2VecModel.transform`` would divide
  by all tokens, so it is not used.  Reviews without any known token get a
  zero vector.
* Means are aggregates in the JVM (map-side combined): plain sums for reviews,
  ``Summarizer.mean`` for groups.
* The representative review per group is an aggregate ``max(struct(sim, -pos, id))``
  — not a window.  Reviews meet their centroid on (key, salt), so a hot group is
  spread over ``salts`` tasks and reduced per salt before its key is combined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.vector import cosine, zeros
from . import skipgram


@dataclass
class WordModel:
    """Trained words: a table (word, vector ARRAY<FLOAT>)."""
    vectors: DataFrame

    def getVectors(self) -> DataFrame:
        return self.vectors


def fit_word2vec(reviews: DataFrame, tokens: str = "tokens", dim: int = P.W2V_DIM,
                 window: int = P.W2V_WINDOW, min_count: int = P.W2V_MIN_COUNT, seed: int = 42,
                 num_partitions: int = 8, max_iter: int = 5, max_sentence: int = 100_000,
                 block_tokens: int = 16_000_000) -> WordModel:
    """M1: one global skip-gram model over all tokenised reviews, five passes (see ``skipgram``).

    The tokens are trained in ``num_partitions`` blocks, or in more of at most ``block_tokens``
    tokens each; the number changes the result, so it does not follow the cluster.  Reviews longer
    than ``max_sentence`` tokens are trained in pieces of that length."""
    return WordModel(skipgram.train(reviews, tokens, dim, window, min_count, seed, num_partitions, max_iter,
                                    max_sentence, block_tokens))


def word_vectors(model: WordModel) -> DataFrame:
    """Vocabulary table (word, vector ARRAY<DOUBLE>)."""
    return model.getVectors().select("word", F.col("vector").cast("array<double>").alias("vector"))


def mean_vectors(df: DataFrame, key, vec: str) -> DataFrame:
    """Element-wise mean of array vectors per key."""
    keys = [key] if isinstance(key, str) else list(key)
    m = df.groupBy(*keys).agg(Summarizer.mean(array_to_vector(F.col(vec).cast("array<double>"))).alias("_m"))
    return m.select(*keys, vector_to_array("_m").alias(vec))


def review_vectors(reviews: DataFrame, vocab: DataFrame, id_col: str = "review_id", tokens: str = "tokens",
                   dim: int = P.W2V_DIM, broadcast_bytes: int = 256 << 20, block_tokens: int = 16_000_000) -> DataFrame:
    """M2: mean of in-vocabulary token vectors; zeros when none is known.

    A vocabulary whose vectors take at most ``broadcast_bytes`` (it is counted first) is
    sent to the tasks, so only sums of whole vectors are shuffled; of a larger one each block of
    ``block_tokens`` tokens gets the vectors of its own words (``_block_sums``)."""
    # count each word once per review first (combined inside the task), so the
    # vocabulary join and the weighted mean see distinct (review, word) pairs
    # the token lists of a review meet first: its counts and its sums are then made where they are;
    # a null id meets no review in the end
    toks = (reviews.where(F.col(id_col).isNotNull()).select(id_col, tokens).repartition(id_col)
                   .select(id_col, F.explode(tokens).alias("word"))
                   .groupBy(id_col, "word").agg(F.count(F.lit(1)).cast("double").alias("_c")))
    if vocab.count() * dim * 8 <= broadcast_bytes:
        hits = toks.join(F.broadcast(vocab), "word").withColumn("_v", F.col("vector").cast("array<double>"))
    else:
        hits = _block_sums(reviews.where(F.col(id_col).isNotNull()).select(F.col(id_col), F.col(tokens).alias("tokens")),
                           vocab, id_col, dim, block_tokens)
    # plain sums have a fixed-width buffer; a vector aggregate falls back to sorting its input
    m = hits.groupBy(id_col).agg(F.sum("_c").alias("_n"),
                                 *[F.sum(F.col("_c") * F.col("_v")[i]).alias(f"_{i}") for i in range(dim)])
    means = m.select(id_col, F.array(*[F.col(f"_{i}") / F.col("_n") for i in range(dim)]).alias("vector"))
    out = reviews.select(id_col).join(means, id_col, "left")
    return out.select(id_col, F.coalesce("vector", zeros(dim)).alias("vector"))


def _block_sums(reviews: DataFrame, vocab: DataFrame, id_col: str, dim: int, block_tokens: int) -> DataFrame:
    """(id, _c, _v): number of known tokens and mean of their vectors, for every row of ``reviews`` that has any.

    The rows are dealt into blocks by their id.  A block's distinct words go to the vocabulary and their
    vectors to the block, so what is shuffled grows with the words of the blocks, and no row is shuffled
    for each word of a review.  Vectors that single floats hold exactly travel as such."""
    import pyarrow as pa

    from ..sources.documents import _stage

    total = reviews.agg(F.sum(F.when(F.size("tokens") > 0, F.size("tokens").cast("long")))).first()[0] or 0
    blocks = max(8, -(-total // block_tokens))
    row_id = reviews.schema[id_col].dataType
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("word", T.StringType()), T.StructField("local", T.IntegerType()),
                           T.StructField("id", row_id), T.StructField("data", T.BinaryType())])

    def encode(batches):
        from pyspark import TaskContext
        block, local = TaskContext.get().partitionId(), {}

        def rows(seq, word, at, ids, data):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(seq), block), pa.int32()), pa.array(seq, pa.int32()), word, at,
                                               ids, data], names=["block", "seq", "word", "local", "id", "data"])

        for b in batches:
            lists = b.column(1)
            if not len(lists):
                continue
            words = lists.flatten().cast(pa.string()).dictionary_encode()
            known, fresh = words.dictionary.to_pylist(), []
            place = np.empty(len(known) + 1, np.int32)
            place[-1] = -1                           # a null is no word
            for i, w in enumerate(known):
                if w not in local:
                    local[w] = len(local)
                    fresh.append(w)
                place[i] = local[w]
            codes = place[words.indices.fill_null(len(known)).to_numpy()]
            size = np.diff(lists.offsets.to_numpy()) * np.asarray(lists.is_valid())
            ends = np.append(0, np.cumsum(size))
            data = pa.array([pa.compress(codes[s:e], codec="zstd", asbytes=True) for s, e in zip(ends[:-1], ends[1:])], pa.binary())
            yield rows(size, pa.nulls(len(b), pa.string()), pa.nulls(len(b), pa.int32()), b.column(0), data)
            if fresh:
                yield rows(np.full(len(fresh), -1), pa.array(fresh, pa.string()),
                           pa.array(np.arange(len(local) - len(fresh), len(local)), pa.int32()),
                           pa.nulls(len(fresh), b.column(0).type), pa.nulls(len(fresh), pa.binary()))

    def packed(batches):
        for b in batches:
            flat = b.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(b), dim)
            single = flat.astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("word"), skipgram._binary(single if (single == flat).all() else flat)],
                                             names=["word", "data"])

    def known(column):
        """The vectors of a column, of single or double floats."""
        size = np.array([len(x) for x in column.to_pylist()])
        if (size == size[0]).all():
            return skipgram._matrix(column, np.float32 if size[0] == 4 * dim else np.float64).copy()
        return np.array([np.frombuffer(x, np.float32 if len(x) == 4 * dim else np.float64) for x in column.to_pylist()], float)

    def sums(batches):
        for _, parts in skipgram._blocks(batches):
            vectors, place, where = [], [], None
            while parts:                             # the words of the block, then its reviews
                b = parts.pop(0)
                n = int((b.column("seq").to_numpy() < 0).sum())
                if n:
                    place.append(b.column("local").slice(0, n).to_numpy())
                    vectors.append(known(b.column("data").slice(0, n)))
                if n == len(b) or where is None and not place:
                    continue
                if where is None:
                    place, vectors = np.concatenate(place), np.concatenate(vectors)
                    where = np.full(int(place.max()) + 1, -1)
                    where[place] = np.arange(len(place))
                at, counts, means = [], [], []
                data, size = b.column("data"), b.column("seq").to_numpy()
                for i in range(n, len(b)):
                    codes = np.frombuffer(pa.decompress(data[i].as_buffer(), int(size[i]) * 4, codec="zstd"), np.int32)
                    codes = where[codes[(codes >= 0) & (codes < len(where))]]
                    codes = codes[codes >= 0]
                    if len(codes):
                        at.append(i)
                        counts.append(float(len(codes)))
                        means.append(vectors[codes].mean(axis=0, dtype=float))
                if at:
                    ends = pa.array(np.arange(len(at) + 1) * dim, pa.int32())
                    yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(at)), pa.array(counts),
                                                      pa.ListArray.from_arrays(ends, pa.array(np.concatenate(means)))],
                                                     names=[id_col, "_c", "_v"])

    coded = _stage(reviews.where(F.size("tokens") > 0).repartition(blocks, id_col).mapInArrow(encode, schema), "coded-reviews")
    binary = vocab.select("word", "vector").mapInArrow(packed, "word string, data binary")
    own = coded.where("seq < 0").select("block", "seq", "word", "local", "id").join(binary, "word").drop("word")
    rows = own.unionByName(coded.where("seq >= 0").drop("word"))
    out = T.StructType([T.StructField(id_col, row_id), T.StructField("_c", T.DoubleType()),
                        T.StructField("_v", T.ArrayType(T.DoubleType()))])
    return _stage(rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "seq").mapInArrow(sums, out),
                  "review-sums")


def centroids(vectors: DataFrame, key: str, vec: str = "vector") -> DataFrame:
    """Product vector = mean of its review vectors (zero vectors included)."""
    return mean_vectors(vectors, key, vec)


def representative(vectors: DataFrame, key: str, id_col: str, vec: str = "vector",
                   order: str | None = None, salts: int = 16) -> DataFrame:
    """Per key the review most similar (cosine) to the key's centroid;
    ties go to the earliest review (``order``, default the id)."""
    order = order or id_col
    cen = centroids(vectors, key, vec).withColumnRenamed(vec, "_c").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    j = vectors.withColumn("_salt", F.pmod(F.hash(id_col), F.lit(salts))).join(cen, [key, "_salt"])
    sim = cosine(F.col(vec).cast("array<double>"), F.col("_c"))
    best = F.max(F.struct(sim.alias("s"), (-F.col(order)).alias("o"), F.col(id_col).alias("i")))
    return (j.groupBy(key, "_salt").agg(best.alias("b"), F.first("_c").alias("_c"))
             .groupBy(key).agg(F.max("b").alias("b"), F.first("_c").alias("_c"))
             .select(key, F.col("_c").alias("product_vector"), F.col("b.i").alias("representative_review_id"),
                     F.col("b.s").alias("representative_similarity")))


# ----------------------------------------------------------------- M4 sentence vectors
def word_weights(reviews: DataFrame, tokens: str = "tokens", a: float = 1e-3) -> DataFrame:
    """(word, weight): a / (a + share of the word among all tokens); frequent words weigh little."""
    counts = reviews.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg(F.sum("_c").cast("double")).scalar()
    return counts.select("word", (F.lit(a) / (F.lit(a) + F.col("_c") / total)).alias("weight"))


def weighted_vectors(reviews: DataFrame, vocab: DataFrame, weights: DataFrame, id_col: str = "review_id",
                     tokens: str = "tokens", dim: int = P.W2V_DIM) -> DataFrame:
    """(id, vector): sum of weight times vector of a review's known tokens, over their number;
    zeros where none is known."""
    known = vocab.join(weights, "word").select(
        "word", F.transform("vector", lambda x: x.cast("double") * F.col("weight")).alias("vector"))
    return review_vectors(reviews, known, id_col, tokens, dim)


def common_direction(vectors: DataFrame, dim: int, vec: str = "vector") -> np.ndarray:
    """Unit direction in which the vectors have their largest sum of squares (not centred).

    The Gram matrix is added up in the tasks, dim x dim numbers each, and summed by
    Spark; only the sum reaches the driver.  Its sign is that of its largest entry;
    zeros if all vectors are zero."""
    import pyarrow as pa

    def gram(batches):
        g = np.zeros((dim, dim))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            g += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": np.arange(dim, dtype=np.int32), "row": list(g)},
                                         schema=pa.schema([("i", pa.int32()), ("row", pa.list_(pa.float64()))]))

    rows = vectors.select(F.col(vec).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    parts = rows.mapInArrow(gram, "i int, row array<double>")
    total = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("row")).alias("s")).collect()     # dim rows
    g = np.zeros((dim, dim))
    for r in total:
        g[r["i"]] = r["s"].toArray()
    values, axes = np.linalg.eigh((g + g.T) / 2)
    u = axes[:, -1]
    if values[-1] <= 0:
        return np.zeros(dim)
    return u * np.sign(u[np.argmax(np.abs(u))])


def sentence_vectors(reviews: DataFrame, vocab: DataFrame, id_col: str = "review_id", tokens: str = "tokens",
                     dim: int = P.W2V_DIM, a: float = 1e-3) -> DataFrame:
    """M4 without a bundled model: frequency-weighted mean of word vectors less the direction that
    all texts share.  A text without known words has zeros.

    ``reviews`` is read for the word shares, the direction and the vectors; stage it if it
    is costly."""
    v = weighted_vectors(reviews, vocab, word_weights(reviews, tokens, a), id_col, tokens, dim)
    u = F.array(*[F.lit(float(x)) for x in common_direction(v, dim)])
    part = F.aggregate(F.zip_with("vector", u, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return (v.withColumn("_along", part)
            .select(id_col, F.zip_with("vector", u, lambda x, y: x - F.col("_along") * y).alias("vector")))


# ----------------------------------------------------------------- M4 embedding plug-in
def hash_embedding_model(dim: int = 64) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A deterministic stand-in sentence encoder: all tokens of the text hashed
    into ``dim`` buckets, L2-normalised; blank text -> zeros.  Any real model
    plugs in with the same ``make_predict_fn`` shape (a transformer applies its
    own maximum input length, e.g. 512 tokens)."""
    def make_predict_fn():
        import zlib

        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for i, t in enumerate(texts):
                if t is None:
                    continue
                for tok in str(t).lower().split():          # the whole text
                    out[i, zlib.crc32(tok.encode()) % dim] += 1.0
                n = np.linalg.norm(out[i])
                if n > 0:
                    out[i] /= n
            return out
        return predict
    return make_predict_fn


def embed(df: DataFrame, text_col: str, make_predict_fn, dim: int,
          batch_size: int = P.EMBED_BATCH) -> DataFrame:
    """M4: batched model inference over Arrow batches (``predict_batch_udf``);
    the model is built once per Python worker."""
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=None)
    return df.withColumn("embedding", udf(F.coalesce(F.col(text_col), F.lit(""))))


def vectorize_reviews(reviews: DataFrame, vectorizers: dict, id_col: str = "review_id") -> DataFrame:
    """M5: one vector column per chosen vectoriser (e.g. ``{"word2vec": fn,
    "bert": fn}``, each ``fn(reviews) -> (id, vector)``); every known name
    missing from the choice becomes a NULL column, like the 'both'/'single' modes."""
    out = reviews
    for name in ("word2vec", "bert"):
        if name in vectorizers:
            v = vectorizers[name](reviews).select(id_col, F.col("vector").alias(name))
            out = out.join(v, id_col, "left")
        else:
            out = out.withColumn(name, F.lit(None).cast("array<double>"))
    for name, fn in vectorizers.items():
        if name not in ("word2vec", "bert"):
            out = out.join(fn(reviews).select(id_col, F.col("vector").alias(name)), id_col, "left")
    return out

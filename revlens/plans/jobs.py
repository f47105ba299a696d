"""End-to-end jobs composed from the operators.

* ``run_preprocessing`` — raw search documents -> typed, standardised,
  de-duplicated products and reviews, text split, min-review filters,
  keyword-group classification, tokens and labels, keyword lists at three
  levels, word vectors, product vectors and representative reviews; written as
  Parquet tables (reviews partitioned by category).
* ``run_incremental`` — the same for the files that no earlier run has done; lists
  over all runs come from mergeable partial sums kept as tables.
* ``run_basic_stats`` — the seven product-metadata tables plus counters, and
  one summary document.

They are a handful of DataFrame plans: the per-file process pool, pickles and
temp files of a single-machine run are replaced by Spark scheduling; the only
barrier is the Word2Vec fit.  Parsed products and intermediate reviews are written
once to the output folder and read back, which cuts lineage and lets the later
stages reuse them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import parse as PA
from ..functions import text as TX
from ..operators import classify as CL
from ..operators import clean as C
from ..operators import keywords as K
from ..operators import stats as S
from ..operators import vectors as V
from ..sources import readers as R
from ..sources import sinks as SK
from ..streaming import incremental as I


PRODUCT = ["source_path", "product_pos"]       # a product of the input: ids may repeat or be missing
TEXT_KIND = [*PRODUCT, "text_kind"]
KEYS = ["category", "product_id"]


class Tables:
    """Where a job writes its tables: a folder each, and with a ``run`` one partition a run.

    A table is written once and read back, which cuts its lineage.  Writing a run
    again replaces that run's partition only; the files of other runs stay as they are."""

    def __init__(self, spark: SparkSession, root: str, run: int | None = None):
        self.spark, self.root, self.run = spark, root, run

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        schema = df.schema
        if self.run is None:
            SK.save_table(df, self.path(name), partition_by=partition_by)
            return self.spark.read.schema(schema).parquet(self.path(name))
        (df.withColumn("run", F.lit(self.run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run", *(partition_by or [])).parquet(self.path(name)))
        return self.spark.read.schema(schema).parquet(f"{self.path(name)}/run={self.run}") if self.has(name) else \
            self.spark.createDataFrame([], schema)

    def has(self, name: str) -> bool:
        """Whether this run has rows in the table."""
        return not (self.spark.read.schema("run int").parquet(self.path(name)).where(F.col("run") == self.run).isEmpty())

    def upto(self, name: str, schema) -> DataFrame:
        """The rows of this run and of all earlier ones."""
        return (self.spark.read.schema(f"{schema}, run int").parquet(self.path(name))
                .where(F.col("run") <= self.run).drop("run"))


def _products(prods: DataFrame) -> DataFrame:
    pi = "product.product_info"
    return prods.select(
        "source_path", "source_file", "category_file", "product_pos",
        F.col(f"{pi}.product_id").alias("raw_product_id"),
        PA.lenient_int(F.col(f"{pi}.product_id")).alias("original_product_id"),
        F.col(f"{pi}.brand").alias("brand"), F.col(f"{pi}.category_path").alias("category_path"),
        F.col(f"{pi}.product_name").alias("product_name"),
        PA.lenient_int(F.col(f"{pi}.price")).alias("price"),
        F.col(f"{pi}.delivery_type").alias("delivery_type"),
        PA.lenient_int(F.col(f"{pi}.total_reviews")).alias("total_reviews"),
        F.col(f"{pi}.product_url").alias("product_url"),
        PA.coerce_rating_map(F.col(f"{pi}.rating_distribution")).alias("rating_distribution"))


def stage_products(raw: DataFrame, files: DataFrame, tables: Tables) -> DataFrame:
    """The products of the readable files with their nested reviews, parsed and written once.

    The files seen, the unreadable ones (no document in them, or not JSON) and the products
    are counted while this is written (S10, A17) and kept as table ``file_counters``."""
    seen, written = Observation("files"), Observation("products")
    bad = F.col("_corrupt_record").isNotNull()
    good = raw.observe(seen, F.count_if(~bad).alias("documents"), F.count_if(bad).alias("file_read_error")) \
        .where(~bad)
    prods = C.unnest_products(good, ("source_path", "source_file", "category_file"))
    nested = tables.save(prods.observe(written, F.count(F.lit(1)).alias("products_read")), "products_raw")
    n = files.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("bytes") == 0).alias("empty"))
    counters = n.select("n_files", (F.lit(seen.get["file_read_error"]) + F.col("empty")).alias("file_read_error"),
                        F.lit(written.get["products_read"]).alias("products_read"))
    tables.save(counters, "file_counters")
    return nested


def build_detail(nested: DataFrame, tables: Tables, tokens: Column, min_reviews: int) -> tuple[DataFrame, DataFrame]:
    """(products kept, reviews in detail) of the staged products: typed, standardised,
    de-duplicated, split by text, filtered, classified, tokenised."""
    products = _products(nested)

    # reviews: flatten, type, normalise, de-duplicate per product (first wins); written once
    flat = C.flatten_reviews(nested.select(*PRODUCT, "category_file", "product"), [*PRODUCT, "category_file"])
    reviews = C.prepare_reviews(flat, PRODUCT).withColumn("has_text", C.has_text("content_norm", "full_text_norm"))
    reviews = tables.save(reviews, "reviews_typed")

    # products: standardise, key, classify (the side with text)
    std = C.standardize_products(products)
    counts = reviews.groupBy(*PRODUCT).agg(F.count(F.lit(1)).alias("collected"),
                                           F.count_if("has_text").alias("with_text_n"),
                                           F.count_if(~F.col("has_text")).alias("without_text_n"))
    std = std.join(counts, PRODUCT, "left")
    text_side = (std.where(F.col("with_text_n") >= min_reviews)          # collected text reviews
                    .withColumn("text_kind", F.lit("with")))
    notext_side = (std.where((F.col("without_text_n") > 0) & (F.col("total_reviews") >= min_reviews))
                      .withColumn("text_kind", F.lit("without")))
    kept = text_side.unionByName(notext_side)
    kept = kept.withColumn("product_id", PA.product_key("category_file", "text_kind", "original_product_id"))
    rv = (reviews.withColumn("text_kind", F.when(F.col("has_text"), "with").otherwise("without"))
                 .join(kept.select(*TEXT_KIND, "product_id"), TEXT_KIND))
    place = F.struct(*PRODUCT).alias("place")
    skin = CL.classify_products(
        text_side.select(place, PA.first_truthy("product_name_clean", "product_name").alias("product_name")),
        rv.where("has_text").select(place, F.col("full_text_norm").alias("full_text"),
                                    F.col("content_norm").alias("content")), key="place", content="content")
    kept = kept.join(skin.select("place.*", F.lit("with").alias("text_kind"), "skin_type"), TEXT_KIND, "left")

    # tokens + labels; written once (cuts lineage, reused by fit and keywords).  The category stands
    # in the files too: a reader that guesses the type of the folder name still has it as text.
    detail = rv.select(*TEXT_KIND, "review_pos", "product_id", "category_file",
                       F.col("category_file").alias("category"), F.col("id").alias("review_id_raw"),
                       PA.lenient_int("id").alias("review_id"),
                       F.col("full_text_norm").alias("full_text"), F.col("score_int").alias("score"), "label",
                       F.col("date_parsed").alias("date"), F.col("date").alias("date_raw"), "nickname",
                       F.when(F.col("has_image"), F.lit(True)).alias("has_image"),
                       F.when(F.col("helpful_int") != 0, F.col("helpful_int")).alias("helpful_count"),
                       F.when(F.col("has_text"), tokens).otherwise(F.array().cast("array<string>")).alias("tokens"))
    detail = (detail.withColumn("char_length", F.length("full_text")).withColumn("token_count", F.size("tokens"))
                    .withColumn("product_key", F.concat_ws("#", *TEXT_KIND))
                    .withColumn("review_key", F.concat_ws("#", "source_path", "product_pos", "review_pos")))
    return kept, tables.save(detail, "reviews_detail_tokens")


def add_vectors(detail: DataFrame, kept: DataFrame, tables: Tables, chosen: dict) -> dict[str, str]:
    """``reviews_detail`` with one vector column per chosen vectoriser; centroid and
    representative of each product.  Returns the paths of the product vectors."""
    text_reviews = detail.where(F.size("tokens") > 0)
    vectors = V.vectorize_reviews(text_reviews.select("review_key", "full_text", "tokens"), chosen, "review_key")
    written = tables.save(detail.join(vectors.select("review_key", "word2vec", "bert"), "review_key", "left"),
                          "reviews_detail", ["category_file"])
    ids = kept.select(F.concat_ws("#", *TEXT_KIND).alias("product_key"), "product_id")
    paths = {}
    for name in chosen:
        held = written.where(F.col(name).isNotNull()).select("product_key", "review_key", "review_pos",
                                                              F.col(name).alias("vector"))
        reps = V.representative(held, "product_key", "review_key", order="review_pos")
        tables.save(reps.join(ids, "product_key"), f"product_vectors_{name}")
        paths[f"product_vectors_{name}"] = tables.path(f"product_vectors_{name}")
    return paths


def run_preprocessing(spark: SparkSession, raw_root: str, out_root: str, stopwords: Iterable[str] = (),
                      analyzer_factory: Callable | None = None, min_reviews: int = P.MIN_REVIEWS_PER_PRODUCT,
                      vectorizer: str = "word2vec", w2v_dim: int = P.W2V_DIM,
                      make_predict_fn: Callable | None = None, model_dim: int = 768) -> dict[str, str]:
    """Run the preprocessing job; returns the written table paths.

    ``vectorizer`` is ``word2vec``, ``bert`` or ``both``; the last two take the
    sentence model from ``make_predict_fn`` and raise without it.  Reviews and
    products are joined by their place in the input (path of the file and position
    in it); ``product_id`` is only written out."""
    if vectorizer not in ("word2vec", "bert", "both"):
        raise ValueError(f"unknown vectorizer {vectorizer!r}")
    if vectorizer != "word2vec" and make_predict_fn is None:
        raise ValueError(f"vectorizer {vectorizer!r} needs make_predict_fn")
    names = ("reviews_detail", "products", "keywords", "sentiment_counts", "group_word_frequency",
             "reviews_typed", "reviews_detail_tokens", "file_counters")
    paths = {n: f"{out_root}/{n}" for n in names}
    tables = Tables(spark, out_root)
    nested = stage_products(R.read_search_json(spark, raw_root, "*.json"), R.list_inputs(spark, raw_root), tables)
    kept, detail = build_detail(nested, tables, _tokens(analyzer_factory, stopwords), min_reviews)

    # keywords at three levels, counts, keyword-group word frequency
    kw_in = detail.select(*KEYS, "label", "tokens")
    SK.save_table(K.sentiment_keywords(kw_in), paths["keywords"])
    SK.save_table(K.sentiment_counts(kw_in), paths["sentiment_counts"])
    SK.save_table(K.group_word_frequency(kw_in), paths["group_word_frequency"])

    chosen = {}
    if vectorizer in ("word2vec", "both"):
        vocab = V.word_vectors(V.fit_word2vec(detail.where(F.size("tokens") > 0), dim=w2v_dim))
        chosen["word2vec"] = lambda r: V.review_vectors(r.select("review_key", "tokens"), vocab, "review_key",
                                                        dim=w2v_dim)
    if vectorizer in ("bert", "both"):
        chosen["bert"] = lambda r: V.embed(r.select("review_key", "full_text"), "full_text", make_predict_fn,
                                           model_dim).select("review_key", F.col("embedding").cast("array<double>")
                                                             .alias("vector"))
    paths |= add_vectors(detail, kept, tables, chosen)
    paths["product_vectors"] = paths["product_vectors_" + ("word2vec" if "word2vec" in chosen else "bert")]
    SK.save_table(kept, paths["products"])
    return paths


def _tokens(analyzer_factory: Callable | None, stopwords: Iterable[str]) -> Column:
    stop = list(stopwords)
    return (TX.analyzer_tokens("full_text_norm", analyzer_factory, stop) if analyzer_factory
            else TX.review_tokens("full_text_norm", stop))


WORD_SUMS = ("category string, product_id string, word string, pos_sum double, neg_sum double, pos_n long, neg_n long, "
             "any_n long")
CLASS_SUMS = "category string, product_id string, " + ", ".join(f"{c} long" for c in K.COUNTS)
GROUP_SUMS = "`group` string, word string, cnt long"


def run_incremental(spark: SparkSession, raw_root: str, out_root: str, stopwords: Iterable[str] = (),
                    analyzer_factory: Callable | None = None, min_reviews: int = P.MIN_REVIEWS_PER_PRODUCT,
                    w2v_dim: int = P.W2V_DIM) -> dict[str, str]:
    """T-1, K8, S9: the preprocessing job over the files that no earlier run has done.

    Files in the manifest are skipped; the rest is one run, and its reviews, products,
    vectors and partial sums go to a partition of their own.  Keywords, counts and group
    word frequencies cover all runs: they come from the merged partial sums, so texts
    of earlier runs are not read again.  The manifest is written last: a run that
    fails is not in it, and the next one takes its number and replaces its partitions.
    Word vectors are trained by the first run that has text and reused, so that
    vectors of all runs can be compared.  Returns the paths; lists that cover all
    runs are under the number of the last one.  Without new files nothing is written.
    """
    manifest = f"{out_root}/manifest"
    done = _read_if_there(spark, manifest, "source_path string, run int")
    last = (done.agg(F.max("run")).first()[0] or 0) if done is not None else 0
    files = R.list_inputs(spark, raw_root)
    fresh = files if done is None else I.new_inputs(files, done.select("source_path"), "source_path")
    new = [r["source_path"] for r in fresh.select("source_path").toLocalIterator()]     # names only
    run = last + 1 if new else last
    lists = ("keywords", "sentiment_counts", "group_word_frequency")
    names = ("reviews_detail", "products", "product_vectors_word2vec", "file_counters", "word_sums", "class_sums",
             "group_sums", "reviews_typed", "reviews_detail_tokens")
    paths = {n: f"{out_root}/{n}" for n in names} | {n: f"{out_root}/{n}/run={run}" for n in lists}
    if not new:
        return paths
    tables = Tables(spark, out_root, run)
    nested = stage_products(R.read_search_json(spark, raw_root, "*.json", only=new),
                            files.where(F.col("source_path").isin(new)), tables)
    kept, detail = build_detail(nested, tables, _tokens(analyzer_factory, stopwords), min_reviews)

    kw_in = detail.select(*KEYS, "label", "tokens")
    tables.save(K.word_sums(K.token_contributions(kw_in, KEYS), KEYS), "word_sums")
    tables.save(K.class_sums(kw_in, KEYS), "class_sums")
    tables.save(K.group_word_sums(kw_in), "group_sums")
    levels = [n for n, _ in K.DEFAULT_LEVELS]
    totals = K.totals_of_sums(tables.upto("class_sums", CLASS_SUMS), KEYS, levels)
    words = K.merge_sums(tables.upto("word_sums", WORD_SUMS), [*KEYS, "word"])
    groups = K.merge_sums(tables.upto("group_sums", GROUP_SUMS), ["group", "word"])
    tables.save(K.score_sums(words, totals, KEYS), "keywords")
    tables.save(totals, "sentiment_counts")
    tables.save(K.ranked_counts(groups, ["group"], P.GROUP_WORD_TOP_N).select("group", "rank", "word", "cnt"),
                "group_word_frequency")

    vocab = _read_if_there(spark, f"{out_root}/word_vectors", "word string, vector array<double>")
    text = detail.where(F.size("tokens") > 0)
    if vocab is None and not text.isEmpty():
        vocab = Tables(spark, out_root).save(V.word_vectors(V.fit_word2vec(text, dim=w2v_dim)), "word_vectors")
    if vocab is not None:
        add_vectors(detail, kept, tables, {"word2vec": lambda r: V.review_vectors(
            r.select("review_key", "tokens"), vocab, "review_key", dim=w2v_dim)})
    tables.save(kept, "products")
    fresh = spark.createDataFrame([(p, run) for p in new], "source_path string, run int")
    fresh.write.mode("append").parquet(manifest)                                        # the commit
    return paths


def _read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table, or None where no run has written it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_basic_stats(spark: SparkSession, products: DataFrame, out_root: str | None = None,
                    fmt: str = "parquet", file_counters: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven product-metadata tables + counters (and a summary document
    when ``out_root`` is given).  ``file_counters`` (table of the preprocessing job, a row a
    run) adds the files seen and the unreadable ones to the counters.  ``products`` needs product_id,
    total_reviews, rating_distribution and a category (``category``, else
    ``category_normal``, else the leaf of ``category_path``, else UNKNOWN)."""
    cols = products.columns
    if "category" in cols:
        category = F.col("category")
    else:   # normalised category, else the leaf of the path, else UNKNOWN
        parts = [F.col("category_normal")] if "category_normal" in cols else []
        if "category_path" in cols:
            parts.append(F.trim(F.element_at(F.split("category_path", ">"), -1)))
        category = PA.first_truthy(*parts, default="UNKNOWN")
    # the first id that is there: product_id, id, productId, product_no
    ids = [F.col(c).cast("string") for c in ("product_id", "id", "productId", "product_no") if c in cols]
    meta = products.select(PA.first_truthy(*ids).alias("product_id"), category.alias("category"),
                           F.col("total_reviews").cast("string").alias("total_reviews"),
                           F.transform_values("rating_distribution", lambda k, v: v.cast("string"))
                           .alias("rating_distribution"))
    prc = S.product_review_counts(meta)
    tables = {
        "category_product": S.category_product_counts(meta),
        "product_review": prc,
        "product_review_count_summary": S.describe(prc, "review_cnt"),
        "product_review_count_bins": S.review_count_bins(prc, spark),
        "score_distribution": S.score_distribution(meta),
        "category_score_distribution": S.score_distribution(meta, ["category"]),
        "category_score_summary": S.category_score_summary(meta),
        "data_quality_counters": S.data_quality_counters(meta),
    }
    if file_counters is not None:
        n = file_counters.agg(F.sum("n_files").alias("n_files"), F.sum("file_read_error").alias("file_read_error"))
        quality = tables["data_quality_counters"]
        tables["data_quality_counters"] = quality.select(*[n.select(c).scalar().alias(c) for c in n.columns], "*")
    if out_root:
        SK.save_tables(tables, out_root, fmt)
        SK.save_table(SK.stats_document(tables), f"{out_root}/summary", "json")
    return tables

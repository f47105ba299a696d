"""Corpus pipeline: language, toxicity, near-duplicates, source mix, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``docs``, whatever they are.  Rows without
a doc_id stay until a stage rejects their text.  An empty table runs through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import language_id, mixing, packing, simhash_dedup, toxicity
from revlens.llm.common import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python by 2,000 rows: bounds the memory of a worker."""
    spark.conf.set(BATCH, "2000")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and texts whose language margin is narrow."""
    _small_batches(spark)
    found = language_id.verdict(language_id.learn(docs, language_id.training_rows()))
    return (docs.select(F.struct("*").alias("row"), found(docs["text"]).alias("found"))
            .filter(~F.col("found.rejected")).select("row.*"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts with a toxicity of 0.3 or more."""
    _small_batches(spark)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return (docs.select(F.struct("*").alias("row"), toxicity.hits_of(lexicon)(docs["text"]).alias("found"))
            .filter(toxicity.probability(lexicon, F.col("found.x")) < 0.3).select("row.*"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-equal texts: that with the smallest doc_id,
    of several the smallest hash of its text.  Rows are told apart by a number of
    their own, so a doc_id on several texts keeps those that are alone."""
    _small_batches(spark)
    rows = stage(docs.select(F.struct("*").alias("row"), simhash_dedup.fingerprint_of(docs["text"]).alias("fp"),
                             F.monotonically_increasing_id().alias("id")), "pipeline-rows")
    keyed = rows.filter("row.doc_id IS NOT NULL")
    root = simhash_dedup.groups(keyed.select("row.doc_id", "fp")).select("fp", "root")
    order = F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("text"), "id")
    first = stage(keyed.groupBy("fp").agg(F.min(order).alias("first")).join(root, "fp"), "pipeline-first")
    least = first.groupBy("root").agg(F.min("first").alias("least"))
    stays = stage(first.select("fp", "root").join(least, "root")
                  .select("fp", F.col("least.id").alias("stays")), "pipeline-stays")
    gone = stage(keyed.select("fp", "id").join(stays, "fp").filter("id <> stays").select("id"), "pipeline-gone")
    return rows.join(gone, "id", "left_anti").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until the sources have their shares."""
    return mixing.mixed_rows(docs, weights=(1, 2, 3), limit=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2,048 tokens."""
    _small_batches(spark)
    return packing.pack(packing.pieces(docs, TOKENIZER, 2048), 2048)


STAGES = [("language_id", language), ("toxicity", toxic), ("simhash_dedup", near_duplicates),
          ("source_mix", source_mix), ("packing", pack)]

#: Compression, a learned lexicon and a tokenizer are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

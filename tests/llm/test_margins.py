"""Narrow language margins, and the rows of the toxicity sample."""

import random

from pyspark.sql import functions as F

from revlens.llm import language_id, toxicity

SF = "/root/testdata/sf0.01"


def test_random_letters_are_rejected_and_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = language_id.learn(docs, language_id.training_rows())
    rng, rows = random.Random(5), []
    for size in (20, 100, 300, 1000, 5000):
        for _ in range(100):
            text = ""
            while len(text) < size:
                text += "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) + " "
            rows.append((len(rows), text))
    random_letters = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), known)
    assert random_letters.filter("rejected").count() >= 0.95 * len(rows)
    held = docs.filter(~language_id.training_rows())
    assert language_id.identify(held, known).filter("rejected").count() <= 0.001 * held.count()


def test_an_id_on_many_rows_brings_few_texts_to_the_sample(spark):
    rows = [(i, f"you utter snoutband number {i}", 1) for i in range(300)]
    rows += [(1000 + i, f"a calm and kindly note {i}", 0) for i in range(600)]
    docs = [(k, t) for k, t, _ in rows] + [(1000, f"flood{i} words") for i in range(3000)]
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    whole = spark.createDataFrame(docs, "doc_id long, text string")
    lexicon = toxicity.learn(whole, labels)
    got = toxicity.score(whole.where(~F.col("text").startswith("flood")), lexicon).join(labels, "doc_id")
    assert got.filter("predicted <> toxic").count() == 0
    again = toxicity.learn(whole.unionByName(whole), labels)              # repeated rows add nothing
    assert again == lexicon

"""Ties, odd rows and the logged form of conversations."""

from pyspark.sql import functions as F

from revlens.llm import chat
from revlens.llm.queries import op8_chat_formatting, op8_events


def test_mask_and_text_share_one_order(spark):
    rows = [(c, t, r, x) for c in range(20) for t, r, x in [(1, "user", "b"), (1, "assistant", "answer one"), (1, "user", "a"),
                                                            (1, None, None), (1, "assistant", "an"), (0, "system", "<|im_end|>"),
                                                            (1, "assistant", "an")]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = chat.render(df.withColumn("formatted", F.lit(1)).withColumn("mask", F.lit(2)).withColumn("_head", F.lit(3)))
    for r in got.collect():
        assert [r.formatted[s.start:s.start + s.length] for s in r.mask] == ["an", "an", "answer one"]
        assert all(r.formatted[s.start + s.length:].startswith(chat.END) for s in r.mask)
    d = chat.digest(got).first()
    assert d.n_turns == 7 and d.loss_chars == 14 and dict(chat.digest(got).dtypes)["n_turns"] == "bigint"
    assert chat.digest(chat.render(df.limit(0))).count() == 0
    alone = chat.digest(chat.render(df.filter("role = 'user'").withColumn("conv_id", F.lit(None).cast("long")))).collect()
    assert len(alone) == 1 and alone[0].n_turns == 40 and alone[0].loss_chars == 0


def test_the_logged_conversations_fold_to_their_texts(spark):
    d = "/root/testdata/sf0.001"
    log = op8_events(spark, d)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    rows = spark.read.parquet(d + "/conversations.parquet")
    want = sorted((r.conv_id, r.role or "", r.text or "") for r in rows.collect())
    got = [(r.conv_id, r.role or "", r.text) for r in chat.fold_events(log).filter("conv_id <> -1").collect()]
    assert sorted(got) == want
    assert op8_chat_formatting(spark, d).count() == rows.select("conv_id").distinct().count() + 1

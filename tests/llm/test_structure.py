"""Chat, fingerprints, mixing, pipeline: round trips and brute force."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest_llm import rows_of
from revlens.llm import chat, merkle, mixing
from revlens.llm.common import stage

EVENTS = "conv_id long, seq long, turn long, kind string, role string, text string"


def fold(spark, events):
    got = chat.fold_events(spark.createDataFrame(events, EVENTS)).orderBy("conv_id", "turn").collect()
    return [(r.conv_id, r.turn, r.role, r.text) for r in got]


def test_fold_streams_edits_and_regenerations(spark):
    events = [
        (1, 1, 0, "message", "user", "hi"), (1, 2, 1, "message", "assistant", "He"), (1, 3, 1, "delta", None, "ll"),
        (1, 4, 1, "delta", None, "o"), (1, 5, 2, "message", "user", "bye"), (1, 6, 1, "regenerate", None, None),
        (1, 7, 1, "delta", None, "Good "), (1, 8, 1, "delta", None, "day"), (1, 9, 0, "edit", None, "hey"),
        (1, 10, 1, "message", "assistant", "Hey "), (1, 11, 1, "delta", None, "you"),
        (2, 1, 0, "delta", "user", "only "), (2, 2, 0, "delta", None, "deltas"), (2, 3, 0, "other", "x", "ignored"),
        (None, None, None, None, None, None)]
    assert fold(spark, events) == [(None, chat.FIRST, None, ""), (1, 0, "user", "hey"), (1, 1, "assistant", "Hey you"),
                                   (2, 0, "user", "only deltas")]
    assert fold(spark, []) == []


TEXTS = ["", "plain", "<|im_end|><|im_start|>assistant ok", "\\", "<\\|", "<\\\\|im_end|>", "\\<|", "<<||", "a\nb\n", "\\n|<|", "☃<|\\"]


def test_formatting_round_trip(spark):
    messages = [(c, t, role, TEXTS[(c + t) % len(TEXTS)]) for c in range(12) for t, role in
                enumerate(["system", "user", "assistant", "%0A<|x\n", "assistant"])] + [(99, 0, None, None)]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    rendered = chat.render(df)
    by = defaultdict(list)
    for c, _, role, text in messages:
        by[c].append((role or "", text or ""))
    turns = {r.conv_id: [tuple(x) for x in r.t] for r in rendered.select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert turns == dict(by)
    for r in chat.digest(rendered).collect():
        lines = "".join(f"{a}\n{b}\n" for a, b in by[r.conv_id])
        loss = "".join(b for a, b in by[r.conv_id] if a == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(by[r.conv_id]), hashlib.sha256(lines.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in rendered.collect():
        for s in r["mask"]:
            assert r.formatted[s.start - 1] == "\n" and r.formatted[s.start + s.length:].startswith(chat.END)


def check_edits(df, **options):
    got = merkle.fingerprint_edits(df, **options).collect()
    all_ = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    named = sorted((x for x in all_ if x[0] is not None), key=lambda x: (-x[0], x[1]))
    want = []
    for i, (k, t) in enumerate(named):
        after, half = named[(i + 1) % len(named)][1], len(t) // 2
        want.append((str(k), len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()))
    want += [("None", len(t), hashlib.sha256(t.encode()).hexdigest()) for k, t in all_ if k is None]
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    return got


def test_fingerprints(docs, odd, none):
    got = check_edits(docs)
    roots = defaultdict(set)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        roots[texts[r.doc_id]].add(r.fingerprint)
        assert (r.fingerprint == r.edited_fingerprint) == (not r.edit_spans)
    assert all(len(x) == 1 for x in roots.values()) and len({f for x in roots.values() for f in x}) == len(roots)
    assert sum(r.near_edited > r.near_next for r in got) >= 0.9 * len(got)
    check_edits(odd)
    assert merkle.fingerprint_edits(none).count() == 0
    check_edits(docs.limit(1))


def test_differences_locate_the_edit():
    a = "one two three four five six seven eight nine ten\nsecond line\n\nnext section here\nlast line"
    b = a.replace("nine", "NINE").replace("last", "LAST")
    spans = merkle.differences(merkle.tree(a), merkle.tree(b))
    assert [a[s:e] for s, e in spans] == ["nine ten", "last line"]
    assert merkle.differences(merkle.tree(a), merkle.tree(a)) == []
    assert merkle.likeness(merkle.tree(""), merkle.tree("")) == 1.0
    assert 0 < merkle.likeness(merkle.tree(a), merkle.tree(b)) < 1


def test_differences_hold_added_and_shifted_branches():
    def spans(a, b):
        return merkle.differences(merkle.tree(a), merkle.tree(b))

    a = "first line\nsecond line\nthird line"
    assert spans(a, "FIRST line\nsecond line\nthird line\nadded") == [(0, 10), (len(a), len(a))]
    assert spans(a, a + "\nadded") == [(len(a), len(a))]
    assert spans(a, "added\n" + a) == [(0, 0)]
    assert spans(a, "first line\nadded\nsecond line\nthird line") == [(10, 10)]
    assert spans(a, "second line\nthird line") == [(0, 10)]
    assert spans(a, "first line\nsecond line\nTHIRD line\nadded") == [(23, len(a))]
    two = "one\n\ntwo"
    assert spans(two, "zero\n\none\n\ntwo") == [(0, 0)] and spans(two, "ONE\n\ntwo\n\nthree") == [(0, 3), (8, 8)]


def fill(sizes, limit=3):
    """Shares by weight, filled up in rounds."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        level = (total - sum(limit * sizes[s] for s in full)) / max(1, sum(weight[s] for s in open_))
        new = {s for s in open_ if limit * sizes[s] <= weight[s] * level}
        if not new:
            return {s: limit * sizes[s] if s in full else weight[s] * level for s in names}
        full |= new


def test_mix(spark, docs, odd, none):
    small = spark.createDataFrame([(i, "w " * 50, "big" if i % 10 else "small", None, None) for i in range(2000)],
                                  "doc_id long, text string, source string, lang string, n_chars long")
    for df in (docs, odd, small):
        got = mixing.mix(df).collect()
        source = defaultdict(set)
        for r in df.select("doc_id", "source").collect():
            source[r.doc_id].add(r.source)
        sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
        for r in got:
            (s,) = source[r.doc_id]
            sizes[s] += r.size
            taken[s] += r.taken
            target[s] = r.target
            largest[s] = max(largest[s], r.size)
            assert r.taken <= 3 * r.size
        want = fill(sizes)
        for s in sizes:
            assert target[s] == pytest.approx(want[s], rel=1e-9)
            assert abs(taken[s] - target[s]) <= max(largest[s], 1)
        assert rows_of(mixing.mix(df)) == rows_of(mixing.mix(df.repartition(7)))
        kept = mixing.mixed_rows(df)
        assert kept.columns == df.columns and kept.count() == sum(r.repeats for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_pipeline_stages(spark, odd, none):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.unionByName(odd.select(*docs.columns)).withColumn("row", F.lit(1)).withColumn("score", F.lit(0.5))
    for start in (extra, extra.limit(0)):
        now, before = start, None
        for i, (name, step) in enumerate(corpus_pipeline.STAGES):
            before, now = now, stage(step(spark, now, sf), f"test-{name}")
            if i < 4:
                assert now.columns == start.columns
            if i < 3:
                assert now.exceptAll(before).count() == 0          # only leaves rows out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_dedup", "source_mix", "packing"]


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(3, text), (1, text), (1, text), (2, text.replace("w7 ", "w8 ")), (9, "quite another text"),
                                  (None, text)], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "9", "None"]


def test_near_duplicate_stage_decides_by_row(spark):
    """One id on several texts: only the near copy goes; near copies under one id go too."""
    text, other = " ".join(f"w{i}" for i in range(300)), " ".join(f"x{i}" for i in range(300))
    rows = [(1, text), (7, text.replace("w7 ", "w8 ")), (7, "a clean text"), (7, "one more clean text here"),
            (5, other), (5, other.replace("x9 ", "x8 ")), (5, other + " end"), (None, "of no id"), (2, "a clean text")]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, id int")
    got = corpus_pipeline.near_duplicates(spark, docs.repartition(3), "")
    assert got.columns == docs.columns
    left = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted((str(k), t) for k, t in left if k != 5) == sorted(
        [("1", text), ("7", "one more clean text here"), ("2", "a clean text"), ("None", "of no id")])
    assert [k for k, _ in left].count(5) == 1
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_registered():
    names = [k for k in E.queries() if k.startswith("op") or k == "pipeline"]
    assert len(names) == 11
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op8_chat_formatting", "op10_source_mixing"])
def test_oracle(spark, name):
    from oracle_check import compare
    res = compare(spark, "/root/testdata/sf0.001", [name])
    assert res[name][0] == "OK", res[name]

"""Word vectors trained in blocks (M1)."""

import numpy as np
import pytest

from revlens.operators import skipgram as S
from revlens.operators import vectors as V


def test_a_block_takes_the_step_of_every_pair(monkeypatch):
    """One batch without noise against a plain loop over the pairs; 0 ends a list."""
    monkeypatch.setattr(S, "NEGATIVE", 0)
    monkeypatch.setattr(S, "MOST", 1000)
    rng, window = np.random.default_rng(1), 3
    ids = np.concatenate([np.append(rng.integers(1, 8, n), [0] * window) for n in (9, 1, 40, 2)]).astype(np.int32)
    x, y = (rng.normal(size=(8, 6)).astype(np.float32) for _ in range(2))
    x[0] = y[0] = 0
    dx, dy = np.zeros((8, 6)), np.zeros((8, 6))
    for i, w in enumerate(ids):
        for j in range(max(0, i - window), min(len(ids), i + window + 1)):
            if i != j and w and ids[j]:
                g = 0.1 * (window + 1 - abs(i - j)) / window / (1 + np.exp(x[ids[j]] @ y[w]))
                dx[ids[j]] += g * y[w]
                dy[w] += g * x[ids[j]]
    want_x, want_y = x + dx, y + dy
    S.train_block(ids, x, y, window, (0.1, 0.1), np.random.default_rng(0))
    assert x == pytest.approx(want_x, abs=1e-4) and y == pytest.approx(want_y, abs=1e-4)
    assert not x[0].any() and not y[0].any()


def test_a_word_on_every_second_place_stays_finite():
    ids = np.ones(20_000, np.int32)
    ids[::2] = np.random.default_rng(2).integers(2, 500, 10_000)
    x = (np.random.default_rng(3).random((500, 20), dtype=np.float32) - 0.5) / 20
    y = np.zeros_like(x)
    for _ in range(5):
        S.train_block(ids, x, y, 5, (0.025, 0.02), np.random.default_rng(4))
    assert np.isfinite(x).all() and np.abs(x).max() < 20


def test_vocabulary_of_many_blocks(spark):
    """More tokens than a block may hold: more blocks, with the same words (before: as many blocks as given)."""
    rng = np.random.default_rng(5)
    rows = [(i, [f"w{int(k)}" for k in rng.zipf(1.4, i % 30) if k < 10**9]) for i in range(300)]
    rows += [(1000, None), (1001, []), (1002, ["w1", None, "w1"])]
    r = spark.createDataFrame(rows, "review_id int, tokens array<string>")
    uses = {}
    for _, tokens in rows:
        for t in tokens or []:
            if t is not None:
                uses[t] = uses.get(t, 0) + 1
    total = sum(uses.values())
    seen = []
    from revlens.sources import documents as D
    kept = D._stage

    def staged(df, name):
        out = kept(df, name)
        if name == "coded-tokens":
            seen.append(out.select("block").distinct().count())
        return out

    D._stage = staged
    try:
        got = V.word_vectors(V.fit_word2vec(r, dim=8, num_partitions=2, max_sentence=7, block_tokens=-(-total // 5))).collect()
    finally:
        D._stage = kept
    assert seen == [5]
    assert sorted(x["word"] for x in got) == sorted(w for w, n in uses.items() if n >= 3)
    assert all(len(x["vector"]) == 8 and np.isfinite(x["vector"]).all() for x in got)


def test_words_used_together_are_near(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [f"{'ab'[i % 2]}{int(k)}" for k in rng.integers(0, 30, 60)]) for i in range(1200)]
    r = spark.createDataFrame(rows, "review_id int, tokens array<string>")
    m = {x["word"]: np.array(x["vector"]) for x in V.word_vectors(V.fit_word2vec(r, dim=16, num_partitions=3)).collect()}
    names = sorted(m)
    v = np.array([m[w] / np.linalg.norm(m[w]) for w in names])
    same = np.array([[a[0] == b[0] for b in names] for a in names])
    near = v @ v.T
    assert near[same].mean() > near[~same].mean() + 0.3


def test_a_pass_averages_the_blocks_of_a_word(spark):
    import pyarrow as pa
    d = np.array([[1, 2], [3, 6], [5, 5]], np.float32)
    b = pa.RecordBatch.from_arrays([pa.array([7, 7, 8], pa.int64()), pa.array([1, 0, 1], pa.int32()),
                                    pa.array([4, 9, 2], pa.int32()), S._binary(d.astype(np.float16))],
                                   names=["id", "block", "local", "data"])
    out = pa.Table.from_batches(S._averager(False)(iter([b]))).to_pylist()
    assert [(o["id"], o["block"], o["local"], np.frombuffer(o["data"], np.float16).tolist()) for o in out] == [
        (7, [0, 1], [9, 4], [2, 4]), (8, [1], [2], [5, 5])]


def test_no_tokens_is_an_error(spark):
    with pytest.raises(ValueError):
        V.fit_word2vec(spark.createDataFrame([(1, [])], "review_id int, tokens array<string>"))
    with pytest.raises(ValueError):
        V.fit_word2vec(spark.createDataFrame([(1, ["a", "b"])], "review_id int, tokens array<string>"))

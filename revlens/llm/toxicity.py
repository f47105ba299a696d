"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded (lower case, homoglyphs and digit substitutions to Latin letters,
everything else to single spaces).  Patterns are beginnings of words and whole
phrases; the longest match at a place counts, so an exception phrase that
contains a lexicon entry cancels it.  Matches do not overlap, so the space between
two words stands twice in the matched line: one closes a word, one opens the next.
The weighted hits are normalised by length and mapped to a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import fold

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ԛ": "q", "ѡ": "w", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "ɑ": "a",
}
# Digits and signs written for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_FOLD = str.maketrans(HOMOGLYPHS | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
                      | {chr(0xFF10 + i): chr(48 + i) for i in range(10)}
                      | {c: None for c in "​‌‍⁠﻿­"})
_SUBS = str.maketrans(SUBSTITUTES)
_DISGUISED = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|(?<!\w)[0134578@$]+(?=[^\W\d_])")
_REST = re.compile(r"[\W\d_]+")


def folded(text: str) -> str:
    """Folded words between single spaces, with one at either end."""
    t = text.lower().translate(_FOLD)
    t = _DISGUISED.sub(lambda m: m[0].translate(_SUBS), t)
    return f" {_REST.sub(' ', t).strip()} "


def _spaced(pattern: str) -> str:
    """``pattern`` for a line whose spaces are doubled: only its inner spaces are."""
    inner = len(pattern) - pattern.endswith(" ")
    return pattern[0] + pattern[1:inner].replace(" ", "  ") + pattern[inner:]


@dataclass
class Lexicon:
    """Patterns (folded, beginning with a space) and weights; 0 marks an exception."""

    weights: dict[str, float] = field(default_factory=dict)
    slope: float = 1.0
    base: float = -3.0

    def automaton(self):
        import ahocorasick
        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            if p.strip():                          # an exception without letters matches nothing
                a.add_word(_spaced(p), w)
        if len(a):
            a.make_automaton()
        return a


def density(text: str, automaton) -> tuple[float, int]:
    """Weighted hits over one plus the log of the length, and the number of hits."""
    line = folded(text)
    if not len(automaton):
        return 0.0, 0
    hits = [w for _, w in automaton.iter_long(line.replace(" ", "  ")) if w > 0]
    return sum(hits) / (1.0 + math.log1p(line.count(" ") / 200.0)), len(hits)



SHORTEST, LONGEST = 3, 8


def _features(text: str) -> set[str]:
    out = set()
    for w in set(folded(text).split()):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


def _frequencies(rows: DataFrame, only: set[str] | None = None) -> DataFrame:
    """(feature, fold, n): number of texts of ``rows`` (text, part) with each feature."""
    held = rows.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = _features(t or "")
                found.update((f, part) for f in (got if held is None else got & held.value))
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([found[k] for k in keys], pa.int64())], names=["feature", "part", "n"])

    return (rows.select("text", "part").mapInArrow(each, "feature string, part int, n long")
            .groupBy("feature", "part").agg(F.sum("n").alias("n")))


def _choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, least: int,
            weight: float) -> dict[str, float]:
    """Shortest reliable beginnings, made as long as they lose no toxic text."""
    def w(f: str) -> float:
        return math.log((toxic.get(f, 0) + 0.5) / (n_toxic + 1)) - math.log((clean.get(f, 0) + 0.5) / (n_clean + 1))

    longer: dict[str, list[str]] = {}
    for f in toxic:
        stem = f[:-1]                              # a whole word hangs below its beginning
        longer.setdefault(stem, []).append(f)
    chosen: dict[str, float] = {}
    for f in sorted(toxic, key=lambda x: (len(x), x)):
        if toxic[f] < least or w(f) < weight or any(f[:k] in chosen for k in range(SHORTEST + 1, len(f))):
            continue
        while True:
            more = [g for g in longer.get(f, []) if toxic[g] >= 0.97 * toxic[f] or toxic[g] > 0.5 * toxic[f]
                    and w(g) > w(f) + 0.5]
            if not more or f.endswith(" "):
                break
            f = max(more, key=lambda g: (toxic[g], g))
        chosen[f] = w(f)
    # words below a chosen beginning that are mostly clean are exceptions
    for f in toxic:
        if f not in chosen and clean.get(f, 0) >= least and w(f) <= 0 and any(f[:k] in chosen for k in range(1, len(f))):
            chosen[f] = 0.0
    return chosen


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = 4000, least: int = 3, weight: float = 3.4, vocabulary: int = 300_000, texts: int = 4,
          exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Lexicon and calibration from labelled rows outside the held-out fold.

    Fitted on a bounded sample: ``sample`` toxic and twice as many clean documents
    (smallest hashes of their ids), at most ``texts`` distinct texts of each id, and the
    ``vocabulary`` most frequent features of the toxic ones.  The lexicon comes from three quarters of it, the calibration
    from the rest, weighted back to the shares of all labelled rows.  ``exceptions``
    are phrases that never count.  Null labels and null keys are left out, a key
    with several labels is toxic if any is.  Without labels of both classes the
    lexicon is empty and every score is the share of toxic labels (0.01 if none).
    """
    known = (labels.select(F.col(key).alias("k"), F.col(label).alias("y")).filter("k IS NOT NULL AND y IS NOT NULL")
             .filter(fold(F.col("k"), 4) != 2).groupBy("k").agg(F.max("y").alias("y")))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    t, c = totals.get(1, 0), totals.get(0, 0)
    if not t or not c:
        share = 0.99 if t else 0.01
        return Lexicon({}, 0.0, math.log(share / (1 - share)))
    order = F.xxhash64("k", F.lit(7))
    few = known.filter("y = 1").orderBy(order, "k").limit(sample).unionByName(
        known.filter("y = 0").orderBy(order, "k").limit(2 * sample))
    rows = (docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("text"))
            .join(F.broadcast(few), "k")               # at most 3 * sample ids
            .groupBy("k", "y", F.pmod(F.xxhash64("text"), F.lit(texts)).alias("_of")).agg(F.min("text").alias("text"))
            .withColumn("part", (F.pmod(F.xxhash64("k", F.lit(11)), F.lit(4)) == 0).cast("int")))
    fit = rows.filter("part = 0")
    sizes = {r["y"]: r["n"] for r in fit.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    common = (_frequencies(fit.filter("y = 1")).filter(F.col("n") >= least)
              .orderBy(F.col("n").desc(), "feature").limit(vocabulary).collect())
    toxic = {r["feature"]: r["n"] for r in common}
    clean = {r["feature"]: r["n"] for r in _frequencies(fit.filter("y = 0"), set(toxic)).collect()}
    weights = _choose(toxic, clean, sizes.get(1, 0), sizes.get(0, 0), least, weight)
    weights |= {folded(e): 0.0 for e in exceptions}
    lexicon = Lexicon(weights)
    held = [(r["x"], r["y"]) for r in rows.filter("part = 1").select(hits_of(lexicon)(F.col("text")).alias("v"), "y")
            .select("v.x", "y").collect()]
    x, y = np.array([h[0] for h in held], dtype=float), np.array([h[1] for h in held], dtype=float)
    weight_of = np.where(y == 1, t / max(1, (y == 1).sum()), c / max(1, (y == 0).sum())) if len(y) else y
    lexicon.slope, lexicon.base = _calibrate(x, y, weight_of, t / (t + c))
    return lexicon


def _calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray, share: float) -> tuple[float, float]:
    """Weighted logistic regression of one variable by Newton steps, lightly shrunk."""
    base = math.log(share / (1 - share))
    if not (0 < y.sum() < len(y)) or x.max() <= 0:
        return 1.0, base
    w = w / w.sum() * len(w)
    scale = float(np.abs(x).max())
    z = np.column_stack([x / scale, np.ones(len(x))])
    theta, ridge = np.array([1.0, base]), np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        grad = z.T @ (w * (p - y)) + ridge @ theta
        step = np.linalg.solve((z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, grad)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(theta[0]) / scale), float(theta[1])


def hits_of(lexicon: Lexicon):
    """Column function: text -> struct(x, hits), the normalised weight and the hits."""
    def each(batches: Iterator["pd.Series"]) -> Iterator["pd.DataFrame"]:  # noqa: F821
        import pandas as pd
        a = lexicon.automaton()
        for texts in batches:
            yield pd.DataFrame([density(t or "", a) for t in texts], columns=["x", "hits"])

    return F.pandas_udf(each, "x double, hits long", F.PandasUDFType.SCALAR_ITER)


def probability(lexicon: Lexicon, x: Column) -> Column:
    z = F.lit(lexicon.slope) * x + F.lit(lexicon.base)
    return 1.0 / (1.0 + F.exp(-F.least(F.greatest(z, F.lit(-40.0)), F.lit(40.0))))


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """(key, score, hits, predicted) per row of ``docs``; null text counts as empty and
    gets the score of a text without hits.  Null keys and repeated rows stay; an
    empty table gives an empty table."""
    return (docs.select(F.col(key).alias("k"), hits_of(lexicon)(F.col(text)).alias("v"))
            .select(F.col("k").alias(key), probability(lexicon, F.col("v.x")).alias("score"), "v.hits")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))

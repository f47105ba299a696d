"""Language model, language, toxicity: contracts, brute force and held-out figures."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import ctw, language_id, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def more(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


def check_base(df, frequent):
    got = ctw.score(df, frequent=frequent).collect()
    rows = [(r.doc_id, words(r.text)) for r in df.select("doc_id", "text").collect()]
    fold = {k: zlib.crc32(b"" if k is None else str(k).encode()) % 10 for k, _ in rows}
    count = Counter(w for k, v in rows if fold[k] for w in v)
    total, low = sum(count.values()), math.log10
    want = sorted((str(k), not fold[k], len(v), sum(count[w] > 0 for w in v), total,
                   round(sum(low((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in v), 4)) for k, v in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    return got


def test_scores_on_odd_rows(odd, none):
    check_base(odd, 1e-6)
    assert ctw.score(none).count() == 0
    nothing = ctw.score(odd.filter("doc_id = 1000")).collect()
    assert nothing == []


def test_joined_and_sent_words_score_alike(docs):
    a = {r.doc_id: r for r in check_base(docs, 1e-6)}
    b = {r.doc_id: r for r in check_base(docs, 1e-2)}         # nearly all words are joined
    assert all(abs(a[k].score - b[k].score) < 1e-6 * abs(a[k].score) for k in a)


def test_tree_beats_token_counts_on_held_out_text(more):
    r = ctw.score(more).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > 1.02 * r.b                                     # both are negative


class SlowTree:
    """Context-tree weighting by its recursion, with plain dictionaries (bits)."""

    def __init__(self, texts):
        self.counts, self.memo = defaultdict(lambda: defaultdict(lambda: [0, 0])), {}
        for t in texts:
            for ctx, q, bit in self.steps(t):
                for d in range(ctw.DEPTH + 1):
                    self.counts[ctx[:d]][q][bit] += 1
        self.kids = defaultdict(list)
        for s in list(self.counts):
            self.kids[s[:-1]] += [s] if s else []

    @staticmethod
    def steps(text):
        before, low = b"", re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode())
        for word in re.findall(rb"[^\x20\x09-\x0D]+", low) + [b"\n"]:
            line = word if word == b"\n" else word + b" "
            for i, byte in enumerate(line):
                ctx = list(line[:i][::-1] + b" " + (before[-2:][::-1] if i < ctw.HEAD else b""))
                ctx = tuple([c or ctw.NUL for c in ctx] + [0] * ctw.DEPTH)[:ctw.DEPTH]
                q = 1
                for k in range(7, -1, -1):
                    bit = (byte or ctw.NUL) >> k & 1
                    yield ctx, q, bit
                    q = 2 * q + bit
            before = word

    def of(self, s, q):
        return self.counts[s][q] if s in self.counts and q in self.counts[s] else (0, 0)

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def pw(self, s, q):
        if (s, q) not in self.memo:
            own = self.kt(*self.of(s, q))
            if len(s) < ctw.DEPTH:
                own = np.logaddexp(own, sum(self.pw(t, q) for t in self.kids[s] if q in self.counts[t])) - math.log(2)
            self.memo[s, q] = float(own)
        return self.memo[s, q]

    def predict(self, ctx, q, bit):
        p, mass = 0.0, 1.0
        for d in range(ctw.DEPTH + 1):
            s = ctx[:d]
            a, b = self.of(s, q)
            stay = 1.0 if d == ctw.DEPTH else math.exp(self.kt(a, b) - math.log(2) - self.pw(s, q))
            p += mass * stay * ((b if bit else a) + .5) / (a + b + 1)
            mass *= 1 - stay
        return p

    def bits(self, text):
        return -sum(math.log2(self.predict(*x)) for x in self.steps(text))


def slow_scores(rows, group):
    """Mixture of the trees of all groups for every row of (doc_id, text, group)."""
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 10]
    kinds = sorted({group(r) for r in train})
    sizes = [sum(group(r) == k for r in train) for k in kinds]
    trees = [SlowTree([r[1] or "" for r in train if group(r) == k]) for k in kinds]
    out = {}
    for r in rows:
        bits = [t.bits(r[1] or "") for t in trees]
        low = min(bits)
        mass = sum((n + 1) / (sum(sizes) + len(sizes)) * 2.0 ** (low - x) for n, x in zip(sizes, bits))
        out[r[0]] = (math.log2(mass) - low) * math.log10(2)
    return out


@pytest.mark.parametrize("frequent", [1e-6, 0.05, 1.0])
@pytest.mark.parametrize("small_parts", [False, True])
def test_scores_equal_the_recursion(spark, monkeypatch, frequent, small_parts):
    if small_parts:                                     # blocks of few units, subtrees apart
        monkeypatch.setattr(ctw, "BLOCK", 100)
        monkeypatch.setattr(ctw, "PAIRS", 1)
    some = ["The cat, the hat", "that thing thins then", "a banana a bandana", "ban an ana", "", None, " \t ", "é à ñandú",
            "x\x00y zero\x00", "the the the the", "Ünder den Linden", "den Hut, der Hut", "a", "ab abc abcd abcdefghij"]
    rows = [(i, some[i % len(some)], [("en"), ("de"), None][i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = slow_scores(rows, lambda r: r[2] or "~")
    got = {r.doc_id: r.score for r in ctw.score(docs, frequent=frequent).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-5 * abs(want[k]) for k in want)


def test_groups_beyond_the_most_share_a_class(spark):
    rows = [(i, f"word{i % 7} of group {i % 5}", f"g{min(i % 5, i % 3)}") for i in range(40)]
    train = Counter(r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 10)
    top = min(train, key=lambda g: (-train[g], g))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = slow_scores(rows, lambda r: "a" if r[2] == top else "b")
    got = {r.doc_id: r.score for r in ctw.score(docs, most=1).collect()}
    assert all(abs(got[k] - want[k]) < 1e-5 * abs(want[k]) for k in want)


def test_rows_without_training_cost_eight_bits_a_byte(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(i, "some text") for i in held], "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = ctw.score(docs).collect()
    assert len(got) == len(held)
    assert all(abs(r.score + 8 * 11 * math.log10(2)) < 1e-4 and r.n_known == 0 for r in got)


def test_order_of_words_changes_the_score(spark):
    rows = [(i, "one two three four five six", "en") for i in range(50)]
    rows += [(1000, "one two three four five six", "en"), (1001, "six three one five two four", "en")]
    got = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1000] > got[1001] + 1


def test_every_context_counts_however_large_the_corpus(spark):
    """One rare word keeps its context among many others."""
    rows = [(i, "common words here " * 200, "en") for i in range(300)] + [(5002, "qzjxvk", "en")]
    assert zlib.crc32(b"5002") % 10
    rows += [(6000, "qzjxvk", "en"), (5001, "kvxjzq", "en")]
    assert not zlib.crc32(b"6000") % 10 and not zlib.crc32(b"5001") % 10
    got = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[6000] > got[5001] + 1


def test_language_on_held_out_rows(more):
    found = language_id.identify(more, language_id.learn(more, language_id.training_rows()))
    held = found.join(more.select("doc_id", "lang"), "doc_id").filter(~language_id.training_rows())
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert found.filter("rejected").count() <= 0.01 * more.count()


def test_language_odd_rows(more, odd, none):
    known = language_id.learn(more, language_id.training_rows())
    got = language_id.identify(odd, known).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    for k in (1, 2, 3):
        assert (by[k].lang_pred, by[k].score, by[k].rejected) == ("und", 0.0, True)
    assert by[4].lang_pred == "en" and by[None].lang_pred == "de" and 0 <= by[5].score <= 1
    assert language_id.identify(none, known).count() == 0
    assert language_id.learn(none, language_id.training_rows()) == []
    assert {r.lang_pred for r in language_id.identify(odd, []).collect()} == {"und"}


def test_language_sample_is_of_distinct_texts_and_whole_texts(spark):
    def word(i):
        return "".join(chr(97 + i // 26 ** k % 26) for k in range(3))

    copies = [(i, "copied text", "xx") for i in range(2000)]
    apart = [(5000 + i, f"own {word(i)}", "xx") for i in range(30)]
    long_ = [(6000 + i, "begin " * 1000 + f"q{word(i)} " * 1000, "yy") for i in range(40)]
    docs = spark.createDataFrame(copies + apart + long_, "doc_id long, text string, lang string")
    known = dict(language_id.learn(docs, F.lit(True), per_lang=50))
    assert {word(i) for i in range(30)} | {"copied", "text", "own"} == set(known["xx"].decode().split())
    assert any(w.startswith("q") for w in known["yy"].decode().split())


def test_equal_sizes_are_rejected():
    assert language_id.sizes("", (("en", b" the "),)) == []
    same = (("en", b" the and "), ("de", b" the and "))
    a, b = language_id.sizes("the and the", same)
    assert a == b


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_rows(more, labels):
    lexicon = toxicity.learn(more, labels)
    got = toxicity.score(more, lexicon).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    r = got.agg(F.sum(F.col("predicted") * F.col("toxic")).alias("hit"), F.sum("predicted").alias("said"),
                F.sum("toxic").alias("all")).first()
    assert r.hit >= 0.6 * r.all and r.hit >= 0.9 * r.said


def test_folding_and_exceptions():
    assert toxicity.folded("1D10T") == " idiot " and toxicity.folded("іdіоt!!") == " idiot "
    assert toxicity.folded("ｉｄｉｏｔ 12") == " idiot " and toxicity.folded("") == "  "
    lexicon = toxicity.Lexicon({" clown": 5.0, " clown fish ": 0.0}, 1.0, -3.0)
    a = lexicon.automaton()
    assert toxicity.density("a cl0wn here", a)[1] == 1
    assert toxicity.density("a clown fish here", a)[1] == 0
    assert toxicity.density("aclown", a)[1] == 0
    short, long_ = toxicity.density("clown", a)[0], toxicity.density("clown " + "word " * 5000, a)[0]
    assert short > long_ > 0


def test_neighbouring_entries_share_a_space():
    lexicon = toxicity.Lexicon({" clown": 5.0, " clown fish ": 0.0, " fool ": 4.0, " twit ": 3.0, " big oaf ": 2.0, "  ": 0.0},
                               1.0, -3.0)
    a = lexicon.automaton()
    for text, hits in (("clown fish clown", 1), ("fool twit", 2), ("fool fool fool", 3), ("twit clown fish fool", 2),
                       ("big oaf big oaf fool", 3), ("clown fish clown fish", 0), ("big fool", 1), ("foolish twit", 1)):
        assert toxicity.density(text, a)[1] == hits, text


def test_hits_equal_a_search_word_by_word():
    rng = np.random.default_rng(3)
    some = ["ab", "abc", "b", "ba", "bab", "c"]
    for _ in range(300):
        make = [" ".join(rng.choice(some, rng.integers(1, 4))) for _ in range(5)]
        weights = {f" {m}" + " " * int(rng.integers(0, 2)): float(rng.integers(0, 3)) for m in make}
        text = " ".join(rng.choice(some, 25))
        line, at, want = f" {text} ", 0, 0
        while at < len(line):
            fit = [p for p in weights if line.startswith(p, at)]
            best = max(fit, key=len) if fit else " "
            want += bool(fit) and weights[best] > 0
            at = line.find(" ", at + max(1, len(best) - 1))     # a closing space opens the next word
            at = len(line) if at < 0 else at
        assert toxicity.density(text, toxicity.Lexicon(weights).automaton())[1] == want, (weights, text)


def test_toxicity_odd_rows(more, labels, odd, none):
    lexicon = toxicity.learn(more, labels)
    got = toxicity.score(odd, lexicon).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(none, lexicon).count() == 0
    for no in (labels.limit(0), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        empty = toxicity.learn(more, no)
        assert empty.weights == {} and {r.predicted for r in toxicity.score(odd, empty).collect()} == {0}

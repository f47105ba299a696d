"""Token counts and packing against the tokenizer libraries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revlens.llm import packing
from revlens.llm.token_counts import merger, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "  a  b\n\n c▁▁d \t<s>x</s> ☃ \n", "aaaaaaaaaaaaaaaaaaaaa", "1 234 <0x0A>  　日本語 é é", "    " * 9 + "x",
       "don't <|endoftext|>x<|startoftext|> É \x1c 12ab #$%", "<|ENDOFTEXT|> THE", "ΑΣ ΣΑΣ İx", "\r\n\x85   z", "▁", "a▁"]


@pytest.mark.parametrize("text", ODD)
def test_merges_equal_the_library(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert merger(PIECES).text(text) == len(sp.encode(text))


def test_token_counts(docs, odd, none):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df in (docs, odd):
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, PIECES).collect())
        want = []
        for r in df.select("doc_id", "text").collect():
            n = len(sp.encode(r.text or ""))
            want.append((str(r.doc_id), len((r.text or "").encode()), n, n > 4096))
        assert got == sorted(want)
    assert token_counts(none, PIECES).count() == 0


def check_sequences(rows, capacity):
    seq = defaultdict(list)
    for r in rows:
        seq[r.sequence_id].append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in parts) <= 2
    return len(seq)


def test_pieces_and_places(spark, docs, odd, none):
    tok = Tokenizer.from_file(WORDS)
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    for df in (docs.select("doc_id", "text").unionByName(extra), odd.select("doc_id", "text")):
        got = packing.pack(packing.pieces(df, WORDS)).collect()
        want = []
        for r in df.collect():
            ids = tok.encode(r.text or "", add_special_tokens=False).ids + [0]
            for k, at in enumerate(range(0, len(ids), 2048)):
                part = np.array(ids[at:at + 2048], dtype="<u4")
                want.append((str(r.doc_id), k, at, len(part), zlib.crc32(part.tobytes())))
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        n = check_sequences(got, 2048)
        assert n <= 1.02 * -(-sum(w[3] for w in want) // 2048) + 1
    assert packing.pack(packing.pieces(none, WORDS)).count() == 0


def test_plan_covers_every_piece_once():
    rng = np.random.default_rng(1)
    for _ in range(30):
        cap = int(rng.integers(4, 60))
        count = {int(n): int(rng.integers(1, 30)) for n in rng.integers(1, cap + 1, 25)}
        plan = packing.pack_histogram(count, cap)
        used = defaultdict(int)
        for runs, n in plan:
            assert n > 0 and sum(a * b for a, b in runs) <= cap
            assert sum(b for a, b in runs if 3 * a > cap) <= 2
            for a, b in runs:
                used[a] += n * b
        assert dict(used) == count
        bins = sum(n for _, n in plan)
        assert bins <= 11 / 9 * -(-sum(a * b for a, b in count.items()) // cap) + sum(
            c for n, c in count.items() if 2 * n > cap) + 1


def test_large_items_are_matched_largest_first():
    assert packing.match_large({60: 1, 40: 2, 35: 1}, 100) == [([(60, 1), (40, 1)], 1), ([(40, 1), (35, 1)], 1)]
    assert packing.match_large({50: 5}, 100) == [([(50, 2)], 2), ([(50, 1)], 1)]

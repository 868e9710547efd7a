"""Token ids by words against the library, and packing against its contract."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from kilnwork.llm import pattern_packing as packing
from kilnwork.llm.word_tokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    with open(PATH) as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library(model, library):
    r = random.Random(3)
    parts = [*"aB1'´s|-.<>é́Σς×÷ßÃÿ。 \n\t\x0b\x1c\x85　", "<|endoftext|>", "'ll", "'T", "l'é", "</w>", "--", "don't", "漢字", "🙂", "x" * 70, "ab" * 40]
    texts = ["", " ", "a" * 5000, "é" * 3000, "ΟΔΟΣ İstanbul", *("".join(r.choices(parts, k=r.randrange(40))) for _ in range(2000))]
    own = WordTokens(model)
    for _ in range(2):  # the second time from memory
        got = own.encode(texts)
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_texts_are_cut_at_white_space(model, library, monkeypatch):
    from kilnwork.llm import word_tokens

    monkeypatch.setattr(word_tokens, "_AT_A_TIME", 64)
    monkeypatch.setattr(word_tokens, "_REMEMBERED", 2000)
    r = random.Random(4)
    texts = [" ".join("".join(r.choices("abé'.1", k=r.choice([2, 9, 200]))) for _ in range(r.randrange(60))) for _ in range(40)]
    assert [g.tolist() for g in WordTokens(model).encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_fit_is_the_least_squares_one_without_negatives():
    r = np.random.default_rng(0)
    for _ in range(20):
        a, b = r.random((6, 15)), r.normal(size=6)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and (slope <= 1e-6).all() and np.allclose(slope[x > 0], 0, atol=1e-6)


def test_patterns_fill_a_sequence():
    held = packing.patterns(12, 3)
    brute = {tuple(sorted(p)) for p in [(a, 12 - a) for a in range(1, 12)] + [(a, b, 12 - a - b) for a in range(1, 11) for b in range(1, 12 - a)]}
    assert {tuple(np.repeat(np.arange(13), row).tolist()) for row in held} == brute and len(held) == len(brute)


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece_and_are_near_the_bound(seed):
    r = np.random.default_rng(seed)
    kind = [r.integers(1, 257, 5000), r.integers(100, 257, 3000), np.full(999, 129), np.array([1] * 700 + [256] * 3), r.geometric(0.02, 20000).clip(1, 256), np.array([], int)][seed]
    histogram = np.bincount(kind, minlength=257)
    groups = packing.plan(histogram, classes=32)
    held = collections.Counter()
    for g in groups:
        assert sum(g.lengths) <= 256 and g.count > 0
        for length in g.lengths:
            held[length] += g.count
    assert held == collections.Counter(kind.tolist())
    least = max(-(-int(kind.sum()) // 256), int((kind > 128).sum()))
    assert sum(g.count for g in groups) <= max(least + 1, int(1.02 * least))


def packed_rows(spark, model, library, rows, capacity=16, **extra):
    df = spark.createDataFrame(rows, "doc_id long, text string, piece string, length string")
    got = packing.pack(df.repartition(3), model, capacity=capacity, with_ids=True, **extra)
    out = got.collect()
    want = []
    for key, text, *_ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            one = ids[start : start + capacity]
            want.append((key, piece, start, len(one), zlib.crc32(np.array(one, "<u4").tobytes()), one))
    have = [(x.doc_id, x.piece, x.start, x.length, x.ids_crc32, x.ids) for x in out]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    inside = collections.defaultdict(list)
    for x in out:
        inside[x.sequence_id].append((x.offset, x.length))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(x.length for x in out)
    return got, len(inside), -(-total // capacity)


def test_packing_of_odd_rows(spark, model, library):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (2, "", "x", "y"), (None, "word " * 50, None, None), (4, "a b c", "", ""), (4, "a b c", "", ""), (5, "é" * 300, "", "")]
    got, used, least = packed_rows(spark, model, library, rows)
    assert used <= least + 1
    whole = {r.sequence_id: (r.ids, r.offsets) for r in packing.sequences(got).collect()}
    assert sum(len(ids) for ids, _ in whole.values()) == sum(r.length for r in got.collect())
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_packing_of_many_documents(spark, model, library):
    r = random.Random(8)
    rows = [(i, " ".join(["the"] * int(min(r.expovariate(0.2), 60))), "", "") for i in range(2500)]
    rows += [(9000 + i, "one of many copies", "", "") for i in range(1200)]
    _, used, least = packed_rows(spark, model, library, rows, capacity=32)
    assert used <= 1.01 * least

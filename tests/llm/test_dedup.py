"""Repeated passages, near duplicates and components against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest

from kilnwork.llm import near_dedup, shingles, suffix_dedup
from kilnwork.llm.components import components


def brute_removal(rows):
    """(doc_id, text) to removed flags, by looking up every 50-byte string."""
    first, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, data in texts:
        for k in range(len(data) - 49):
            if i is not None:
                first[data[k : k + 50]] = min(i, first.get(data[k : k + 50], i))
    for i, data in texts:
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if i is not None and first[data[k : k + 50]] < i:
                gone[k : k + 50] = b"\x01" * 50
        out.append((i, data, gone))
    return out


def compare(spark, rows, extra=()):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, spans string")
    got = suffix_dedup.remove_repeats(df).collect()
    want = []
    for i, data, gone in brute_removal(rows):
        left = bytes(b for b, g in zip(data, gone) if not g)
        spans = [k for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1])]
        want.append((i, len(data), sum(gone), len(spans), hashlib.sha256(left).hexdigest()))
    have = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got]
    key = lambda r: (r[0] is None, r)
    assert sorted(have, key=lambda r: repr(key(r))) == sorted(want, key=lambda r: repr(key(r)))


def test_removal_of_random_texts(spark):
    r = random.Random(5)
    passages = ["".join(r.choice("abé ") for _ in range(r.randrange(30, 120))) for _ in range(12)]
    rows = [(i, "".join(r.choice([*passages, "".join(r.choice("abcd ") for _ in range(20))]) for _ in range(r.randrange(8)))) for i in range(60)]
    r.shuffle(rows)
    compare(spark, rows)


def test_removal_of_odd_rows(spark):
    run = "a" * 200
    rows = [
        (1, None), (2, ""), (3, run), (4, run), (4, run + "b"), (None, run), (None, None), (5, "ab" * 100), (6, "ba" * 100),
        (7, "x" * 49), (8, "x" * 49), (9, "x" * 50), (10, "x" * 50), (-3, "é" * 60), (11, "ü" + "é" * 60), (12, "abc" * 5000), (13, "abc" * 5000),
    ]
    compare(spark, rows)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_anchors_are_dealt_out_by_window(spark, monkeypatch):
    r = random.Random(2)
    shared = "every document begins with this very same line of boilerplate text, "
    rows = [(i, shared + "".join(r.choice("abcdefgh ") for _ in range(150))) for i in range(40)]
    monkeypatch.setattr(suffix_dedup, "HOT_DOCUMENTS", 3)
    compare(spark, rows)


def test_removed_text_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, keep=["doc_id", "lang"]).collect()}
    for i, data, gone in brute_removal(rows):
        left = bytes(b for b, g in zip(data, gone) if not g)
        assert got[i]["n_removed"] == sum(gone) and got[i]["kept_sha256"] == hashlib.sha256(left).hexdigest()


def test_longest_previous_factor_looks_both_ways():
    data = np.frombuffer(b"abcdefgh" * 3, np.uint8)
    starts = np.array([0, 8, 16])
    for docs in ([0, 1, 2], [2, 1, 0], [1, 0, 1], [5, 5, 5]):
        got = suffix_dedup.previous_factor_reached(data, starts, np.array(docs), 8)
        assert got.tolist() == [d > min(docs) for d in docs]


def bag(text):
    words = [w for w in text.replace("\t", " ").split() if w]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    return collections.Counter(grams)


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def near_texts(seed, n=40):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(80)]
    base = [[r.choice(words) for _ in range(r.randrange(1, 90))] for _ in range(8)]
    out = []
    for _ in range(n):
        text = list(r.choice(base))
        for _ in range(r.randrange(4)):
            text[r.randrange(len(text))] = r.choice(words)
        out.append(" ".join(text * r.choice([1, 1, 2])))
    return out


def test_pairwise_similarity_is_that_of_multisets():
    texts = [*near_texts(1), "", "a a a a a a a a a", "a a a a a a"]
    got = shingles.pairwise_similarity(texts, columns=64)
    found = [bag(t) for t in texts]
    want = np.array([[jaccard(a, b) for b in found] for a in found])
    assert np.allclose(got, want, atol=1e-5)


def test_signatures_agree_as_often_as_multisets_overlap():
    r = random.Random(3)
    a = [f"w{r.randrange(60)}" for _ in range(300)]
    texts = [" ".join(a), " ".join(a[:250] + a[:250][::-1][:50]), " ".join(a * 3), " ".join(a)]
    values = near_dedup.signatures(texts, 4096)
    assert (values[0] == values[3]).all()
    for i, j in ((0, 1), (0, 2), (1, 2)):
        want = jaccard(bag(texts[i]), bag(texts[j]))
        assert abs((values[i] == values[j]).mean() - want) < 4 * (want * (1 - want) / 4096) ** 0.5 + 0.003
    assert np.isinf(near_dedup.signatures([""], 16)).all()


@pytest.mark.parametrize("options", [{}, {"block_rows": 5}, {"block_bytes": 600}])
def test_classes_are_those_of_all_links(spark, options):
    texts = near_texts(7, 60)
    rows = [(100 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(df, **options).collect()}
    found = {i: bag(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, t in rows:
        for j, u in rows:
            if t == u or jaccard(found[i], found[j]) >= 0.8:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: top(i) for i, _ in rows}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "one"), (5, "one"), (None, "one"), (None, "alone"), (6, "x " * 20000), (7, "x " * 20000), (4, "one")]
    df = spark.createDataFrame([(i, t, "e") for i, t in rows], "doc_id long, text string, class_id string")
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    classes = {(r["doc_id"], r["text_md5"]): (r["class_id"], r["kept"]) for r in got}
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    assert classes[2, md5("")] == (1, False) and classes[3, md5("  ")] == (3, True) and classes[5, md5("one")] == (4, False)
    assert classes[None, md5("one")] == (4, False) and classes[None, md5("alone")] == (None, True) and classes[7, md5("x " * 20000)] == (6, False)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(30)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200 + i) for i in range(1, 30)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

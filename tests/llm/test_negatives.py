"""Hard negatives against all pairs, and the bounds that spare them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.llm import hard_negatives as hard


def brute(rows, modulus=10):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if i is not None and label is not None and fine(v)]
    out = []
    for i, label, v in rows:
        if i % modulus:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows]
        own = sorted((-s, j) for s, j, other in scored if other == label and j != i)[:5]
        for s, j in own:
            fit = sorted((-t, k) for t, k, other in scored if other != label and 80 * -s <= 100 * t <= 100 * -s)[:5]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(fit, 1)]
    return sorted(out)


def check(spark, rows, monkeypatch=None, modulus=10):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, label int, embedding array<double>, bits string, aligned double")
    got = hard.mine(hard.usable(df.repartition(4)), F.col("vec_id") % modulus == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, modulus)


@pytest.mark.parametrize("width", [1, 3, 64, 100])
def test_intervals_hold_the_products(width):
    r = np.random.default_rng(width)
    rows = np.floor(256 * np.concatenate([r.normal(size=(300, width)), np.zeros((2, width)), 1e6 * r.normal(size=(20, width))]))
    codes = hard.Codes.of(rows)
    for vector in rows[::20]:
        low, high = hard.Query(vector).interval(codes)
        true = rows @ vector
        assert (low <= true).all() and (true <= high).all()


def test_intervals_spare_most_rows():
    r = np.random.default_rng(0)
    centres = r.normal(size=(50, 64))
    rows = np.floor(256 * (centres[r.integers(0, 50, 5000)] + 0.1 * r.normal(size=(5000, 64))))
    codes = hard.Codes.of(rows)
    near = hard._best(hard.Query(rows[0]), codes, 5)
    assert len(near) < 500 and set(np.argsort(-(rows @ rows[0]))[:5]) <= set(near)


def test_random_vectors(spark):
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 20))
    rows = [(int(i), int(r.integers(0, 3)), (centres[i % 6] + 0.2 * r.normal(size=20)).tolist()) for i in r.permutation(400)]
    check(spark, rows)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(hard, "BLOCK_ROWS", 7)
    monkeypatch.setattr(hard, "BLOCK_QUERIES", 3)
    r = np.random.default_rng(5)
    rows = [(i, i % 4, r.normal(size=5).round(1).tolist()) for i in range(150)]
    check(spark, rows)


def test_odd_rows(spark):
    same = [0.5, 0.25, -0.5]
    rows = [(i, i % 2, same) for i in range(60)] + [(10, 0, same), (10, 0, same), (3, 1, same)]
    rows += [(100, None, same), (None, 1, same), (120, 1, None), (130, 1, [0.1, None, 0.2]), (140, 0, [float("nan"), 1.0, 1.0]), (150, 0, [float("inf"), 1.0, 1.0])]
    rows += [(160, 5, [0.0, 0.0, 0.0]), (170, 7, [5e6, -5e6, 5e6]), (171, 7, [5e6, 5e6, 5e6]), (172, 8, [5e6, 4e6, 4.5e6]), (180, 9, [-1.0, -1.0, -1.0])]
    check(spark, rows)
    check(spark, [(10, 1, []), (11, 1, []), (12, 2, []), (13, 1, [1.0])])
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard.mine(hard.usable(empty), F.col("vec_id") % 100 == 0).count() == 0
    none = spark.createDataFrame([(1, 1, [1.0]), (2, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard.mine(hard.usable(none), F.col("vec_id") % 100 == 0).count() == 0


def test_large_scores_stay_within_longs():
    vectors = np.array([[2.0**62, 2.0**62], [-(2.0**62), 1.0], [3.0, 4.0]])
    codes = hard.Codes.of(vectors)
    assert hard.Query(vectors[0]).scores(codes).tolist() == [2**63 - 1, -(2**63) + 1, 7 * 2**62 if 7 * 2**62 < 2**63 else 2**63 - 1]

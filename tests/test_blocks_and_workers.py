"""Scores by a join of blocks, and training by workers that stay up."""

import io

import numpy as np
import pytest
from contextlib import redirect_stdout
from pyspark.sql import functions as F

from kilnwork.operators import blocked, sampling, scoring, search, training, workers


def weight_rows(r, classes, width, bias=True):
    rows = [(c, p, float(r.normal())) for c in classes for p in range(-1 if bias else 0, width) if r.random() < 0.8]
    return rows + [(classes[0], 0, 0.5), (classes[0], width - 1, 0.25)]


@pytest.mark.parametrize("sizes", [(7, 2, 3), (4096, 1024, 1024), (1, 1, 1), (50, 100, 2)])
def test_joined_scores_are_those_of_one_product(spark, sizes):
    r = np.random.default_rng(sum(sizes))
    width, classes = 8, [0, 1, 2, 5, 9, 17]
    rows = [(i % 9, f"p{i}", [float(v) for v in r.normal(size=width)]) for i in range(41)]
    rows += [(100, None, None), (101, "short", [1.0]), (102, "nan", [float("nan")] * width), (None, "x", [0.0] * width), (3, "again", [1.0] * width), (3, "again", [1.0] * width)]
    df = spark.createDataFrame(rows, "id long, path string, x array<double>").repartition(3)
    weights = spark.createDataFrame(weight_rows(r, classes, width), "class_id int, pos int, weight double")
    for on_error in ("zero", "null"):
        want = scoring.score_linear(df, weights, features="x", keep=["id"], on_error=on_error)
        got = blocked.score_join(df, weights, features="x", keep=["id"], on_error=on_error, block_rows=sizes[0], block_classes=sizes[1], block_positions=sizes[2])
        assert got.columns == want.columns
        flat = lambda d: sorted(((*x[:2], None if x[2] is None else round(x[2], 9), x[3], x[4] and [round(v, 9) for v in x[4]], *x[5:]) for x in map(tuple, d.collect())), key=repr)
        assert flat(got) == flat(want)
    with pytest.raises(Exception, match="unusable features"):
        blocked.score_join(df, weights, features="x", on_error="fail").collect()


def test_joined_scores_of_few_classes_and_no_rows(spark):
    weights = spark.createDataFrame([(4, 0, 1.0), (4, -1, 2.0), (7, 0, -1.0)], "class_id int, pos int, weight double")
    one = spark.createDataFrame([(1, [0.5])], "id int, x array<float>")
    got = blocked.score_join(one, weights, features="x", path=None, keep=["id"]).first()
    assert got["top_5_classes"] == [4, 7] and abs(sum(got["top_5_scores"]) - 1) < 1e-12 and got["file_path"] is None
    assert blocked.score_join(one.limit(0), weights, features="x").count() == 0
    with pytest.raises(ValueError, match="empty"):
        blocked.score_join(one, weights.limit(0), features="x")


def test_blocks_meet_by_an_equi_join_and_rows_are_read_once(spark):
    weights = spark.createDataFrame([(c, p, 1.0) for c in range(9) for p in range(9)], "class_id int, pos int, weight double")
    rows = spark.range(50).select("id", F.array([F.rand(i) for i in range(9)]).alias("x"))
    out = io.StringIO()
    with redirect_stdout(out):
        blocked.score_join(rows, weights, features="x", keep=["id"], block_classes=2, block_positions=4).explain("formatted")
    plan = out.getvalue()
    assert "Join" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan and "MapInArrow" in plan


def labelled(spark, n=240, width=3, classes=4, seed=1):
    r = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in r.normal(size=width)], int(r.integers(classes))) for i in range(n)]
    return sampling.split_train_test(spark.createDataFrame(rows, "id long, x array<double>, y int"), "id")


@pytest.mark.parametrize("count", [1, 2, 4])
def test_workers_step_like_passes(spark, count):
    rows, trainable = labelled(spark), training.SoftmaxRegression(3, 4, 0.1)
    trials = search.param_space(spark, 3)
    got = workers.train_workers(rows, trials, trainable, features="x", label="y", steps=4, workers=count).orderBy("step", "trial_id").collect()
    table = trials.orderBy("trial_id").toArrow()
    lr, momentum = (table.column(n).to_numpy() for n in ("lr", "momentum"))
    params = trainable.initial(np.arange(3))
    velocity = np.zeros_like(params)
    sums = training.training_pass(rows, trainable, params, "x", "y")
    for step in range(1, 5):
        loss = sums.loss / sums.train_rows
        params, velocity = training.momentum_step(params, velocity, sums.gradient / sums.train_rows, lr, momentum)
        sums = training.training_pass(rows, trainable, params, "x", "y")
        for t in range(3):
            r = got[3 * (step - 1) + t]
            assert (r["trial_id"], r["step"], r["train_rows"], r["test_rows"]) == (t, step, sums.train_rows, sums.test_rows)
            assert np.allclose(r["params"], params[t], atol=1e-12) and np.isclose(r["loss"], loss[t]) and np.isclose(r["accuracy"], sums.correct[t] / sums.test_rows)
    assert len(got) == 12


def test_workers_without_rows_of_their_own(spark):
    rows, trainable = labelled(spark, n=2).withColumn("is_test", F.lit(False)), training.SoftmaxRegression(3, 4)
    got = workers.train_workers(rows, search.param_space(spark, 1), trainable, features="x", label="y", steps=2, workers=4).collect()
    assert len(got) == 2 and all(r["train_rows"] == 2 and r["accuracy"] is None for r in got)
    assert workers.train_workers(rows.limit(0), search.param_space(spark, 1), trainable, features="x", label="y", steps=1, workers=2).count() == 0
    assert workers.train_workers(rows, search.param_space(spark, 0), trainable, features="x", label="y", steps=1, workers=2).count() == 0


def test_workers_refuse_what_does_not_fit(spark, monkeypatch):
    rows, trainable = labelled(spark), training.SoftmaxRegression(3, 4)
    trials = search.param_space(spark, 1)
    with pytest.raises(ValueError, match="at least 1"):
        workers.train_workers(rows, trials, trainable, features="x", label="y", steps=0, workers=1)
    monkeypatch.setattr(workers, "MAX_EXCHANGE_BYTES", 100)
    with pytest.raises(ValueError, match="too large to exchange"):
        workers.train_workers(rows, trials, trainable, features="x", label="y", steps=1, workers=1)
    monkeypatch.undo()
    broken = rows.withColumn("x", F.when(F.col("id") != 5, F.col("x")))
    with pytest.raises(Exception, match="unusable features"):
        workers.train_workers(broken, trials, trainable, features="x", label="y", steps=1, workers=2).collect()

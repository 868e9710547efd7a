import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.cli import search as command
from kilnwork.operators import quantiles, search

METRICS = "trial_id long, training_iteration int, mean_accuracy double"


def metrics(spark, rows):
    return spark.createDataFrame(rows, METRICS)


def test_rung_levels():
    assert search.rung_levels() == [1, 4, 16, 64]
    assert search.rung_levels(2, 3, 20) == [2, 6, 18]
    with pytest.raises(ValueError):
        search.rung_levels(0)


def test_param_space(spark):
    rows = search.param_space(spark).toPandas()
    assert len(rows) == 50 and rows.trial_id.is_unique
    assert rows.lr.between(1e-4, 1e-2).all() and rows.momentum.between(0.1, 0.9).all()
    again = search.param_space(spark).repartition(3).toPandas().sort_values("trial_id")
    assert np.array_equal(rows.sort_values("trial_id").lr, again.lr)


def test_report_metrics(spark):
    df = spark.createDataFrame(
        [(1, 1, 3, 4), (1, 1, 1, 4), (2, 1, 4, 4)], "trial_id long, training_iteration int, correct long, total long"
    )
    got = {r["trial_id"]: r["mean_accuracy"] for r in search.report_metrics(df, "correct", "total").collect()}
    assert got == {1: 0.5, 2: 1.0}


def test_halving_keeps_the_best_quarter(spark):
    rows = [(t, i, (t + i) / 200) for t in range(100) for i in (1, 2, 4, 5)]
    got = search.halving_rungs(metrics(spark, rows)).toPandas()
    assert set(got.training_iteration) == {1, 4}
    for level, rung in got.groupby("training_iteration"):
        cut = np.quantile(rung.mean_accuracy, 0.75)
        assert np.allclose(rung.cut, cut)
        assert (rung.keep == (rung.mean_accuracy >= cut)).all()
        assert rung.keep.sum() == 25
        kept = search.survivors(list(zip(rung.trial_id, rung.mean_accuracy)))
        assert kept == set(rung[rung.keep].trial_id)


def test_halving_of_ties_and_of_nothing(spark):
    got = search.halving_rungs(metrics(spark, [(t, 1, 0.5) for t in range(5)])).collect()
    assert all(r["keep"] for r in got)
    assert search.halving_rungs(metrics(spark, [])).count() == 0
    assert search.survivors([(1, float("nan"))]) == set()


@pytest.mark.parametrize("limit", [1, 2, 10, 100_000])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_quantiles_are_exact_however_few_rows_are_sorted(spark, limit, q):
    rng = np.random.default_rng(5)
    groups = {
        1: rng.normal(size=500),
        2: np.round(rng.exponential(size=400), 1),  # many ties
        3: np.array([7.5]),
        4: np.full(300, -2.0),
        5: np.array([0.0, 1e-300, 1.0, 1e300]),
        6: np.concatenate([np.zeros(200), [1.0, 2.0]]),
        7: np.array([1.0, 2.0]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(1, None), (2, math.nan), (99, 1.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(4).cache()
    got = quantiles.quantile_by_group(df, "g", "v", q, list(groups), sort_limit=limit)
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert np.isclose(got[g], np.quantile(vs, q), rtol=1e-12, atol=0), (g, q, limit)
    df.unpersist()


def test_quantiles_of_a_hot_group(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise((F.col("id") % 7 + 2)).cast("int").alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 10**9).alias("v"),
    )
    got = quantiles.quantile_by_group(df, "g", "v", 0.75, list(range(1, 9)), sort_limit=1000)
    want = df.groupBy("g").agg(F.percentile("v", F.lit(0.75)).alias("p")).collect()
    assert len(got) == 8
    assert all(math.isclose(got[r["g"]], r["p"]) for r in want)


def test_quantiles_check_the_number_of_groups(spark):
    with pytest.raises(ValueError):
        quantiles.quantile_by_group(spark.range(1).withColumn("v", F.lit(1.0)), "id", "v", 0.5, range(20_000))


def test_until_stopped(spark):
    rows = [(1, 1, 0.5), (1, 2, 0.99), (1, 3, 0.5), (2, 1, 0.1), (2, 2, 0.2), (3, 9, 0.1), (3, 10, 0.1), (3, 11, 0.1)]
    got = search.until_stopped(metrics(spark, rows), 0.98, 10).collect()
    kept = {(r["trial_id"], r["training_iteration"]): r["stop_iteration"] for r in got}
    assert kept == {(1, 1): 2, (1, 2): 2, (2, 1): None, (2, 2): None, (3, 9): 10, (3, 10): 10}


def test_best_trial(spark):
    df = metrics(spark, [(1, 1, 0.9), (1, 2, 0.6), (2, 1, 0.7), (2, 2, 0.7), (3, 1, 0.7)])
    params = search.param_space(spark, 5)
    last, best = search.best_trial(df, params).first(), search.best_trial(df, params, scope="all").first()
    assert (last["trial_id"], last["mean_accuracy"]) == (2, 0.7)
    assert (best["trial_id"], best["training_iteration"]) == (1, 1)
    assert best["lr"] == params.filter("trial_id = 1").first()["lr"]
    with pytest.raises(ValueError):
        search.best_trial(df, params, scope="avg")


def test_trial_errors(spark):
    df = spark.createDataFrame([(1, None), (2, "boom")], "trial_id long, error string")
    assert search.trial_errors(df).first().asDict() == {"trials": 2, "errors": 1, "ok": False}
    assert search.trial_errors(df.filter("trial_id = 1")).first()["ok"] is True


@pytest.mark.parametrize("options", [["--model", "conv"], ["--model", "linear", "--mode", "full"]])
def test_search_command(spark, sf_dir, tmp_path, capsys, options):
    state = str(tmp_path / "state")
    command.main(
        ["--data", f"{sf_dir}/embeddings.parquet", "--key", "vec_id", "--features", "embedding", "--smoke-test"]
        + ["--checkpoint-path", state, *options]
    )
    assert '{"best": {"trial_id": 0, "training_iteration": 5, "mean_accuracy": 0.' in capsys.readouterr().out
    command.main(
        ["--data", f"{sf_dir}/embeddings.parquet", "--key", "vec_id", "--features", "embedding", "--smoke-test"]
        + ["--checkpoint-path", state, "--resume", *options]
    )
    assert '"training_iteration": 5' in capsys.readouterr().out


def test_conv_training_learns(spark):
    """Bright left halves against bright right halves."""
    from kilnwork.operators import sampling, training

    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 800)
    x = rng.normal(size=(800, 8, 8))
    x[y == 0, :, :4] += 1.5
    x[y == 1, :, 4:] += 1.5
    df = spark.createDataFrame(
        [(i, v.ravel().tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))], "id long, x array<float>, label int"
    )
    trials = spark.createDataFrame([(0, 0.05, 0.9), (1, 1e-6, 0.1)], "trial_id long, lr double, momentum double")
    result = search.run_search(
        sampling.split_train_test(df, "id"), trials, training.ConvClassifier(side=8, classes=2),
        key="id", features="x", label="label", mode="minibatch", max_iterations=4, horizon=None,
    )
    best = result.best.first()
    assert best["trial_id"] == 0 and best["mean_accuracy"] > 0.9


def test_quantiles_of_groups_with_infinities_are_the_same_at_any_size(spark):
    inf = float("inf")
    groups = {
        1: [float(i) for i in range(20)] + [inf] * 3,
        2: [-inf, -inf, 1e308, -1e308, 0.0, 5e-324, 1.0, 2.0, inf],
        3: [inf, inf],
        4: [-1.5e308, 1.5e308, 0.25],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g long, v double")
    for q in (0.0, 0.25, 0.5, 0.75, 1.0):
        sorted_in_one = quantiles.quantile_by_group(df, "g", "v", q, list(groups))
        narrowed = quantiles.quantile_by_group(df, "g", "v", q, list(groups), sort_limit=0)
        assert repr(sorted_in_one) == repr(dict(sorted(narrowed.items(), key=lambda x: list(sorted_in_one).index(x[0]))))


def test_reports_that_are_not_finite_never_win(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, 0.5), (2, 1, nan), (3, 1, None), (4, 1, inf), (5, 1, 0.7), (5, 1, 0.6)]
    metrics = spark.createDataFrame(rows, "trial_id long, training_iteration int, mean_accuracy double")
    params = spark.createDataFrame([(i, 0.1, 0.2) for i in range(1, 6)], "trial_id long, lr double, momentum double")
    for scope in ("last", "all"):
        best = search.best_trial(metrics, params, scope).first()
        assert (best["trial_id"], best["mean_accuracy"]) == (5, 0.7)
    kept = {(r["trial_id"], r["mean_accuracy"]): r["keep"] for r in search.halving_rungs(metrics.filter("trial_id <> 4")).collect()}
    assert not any(k for (t, _), k in kept.items() if t in (2, 3)) and kept[5, 0.7]
    stopped = search.until_stopped(metrics, target=0.65).collect()
    assert {r["trial_id"] for r in stopped if r["stop_iteration"] == 1} == {5}

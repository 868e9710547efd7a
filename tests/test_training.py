import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.operators import sampling, search, training
from kilnwork.plans import training as plans
from kilnwork.sinks import checkpoints


def blobs(spark, n=600, d=5, k=3, seed=0, noise=1.0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    centres = np.eye(k, d) * 3
    x = centres[y] + noise * rng.normal(size=(n, d))
    rows = [(int(i), v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int").repartition(4)
    return sampling.split_train_test(df, "id"), x, y


def is_test_mask(df, n):
    flags = {r["id"]: r["is_test"] for r in df.collect()}
    return np.array([flags[i] for i in range(n)])


@pytest.mark.parametrize(
    "trainable,width",
    [(training.SoftmaxRegression(5, 3), 5), (training.ConvClassifier(side=8, filters=2, classes=3), 64)],
)
def test_gradient_against_differences(trainable, width):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(7, width)), rng.integers(0, 3, 7)
    params = rng.normal(size=(2, trainable.n_params)) * 0.5
    grads, losses = trainable.gradient(params, x, y)
    assert grads.shape == params.shape and losses.shape == (2,)
    for j in range(0, trainable.n_params, 3):
        step = np.zeros_like(params)
        step[:, j] = 1e-6
        up, down = trainable.gradient(params + step, x, y)[1], trainable.gradient(params - step, x, y)[1]
        assert np.allclose((up - down) / 2e-6, grads[:, j], atol=1e-5)


def test_training_pass_matches_numpy_on_any_partitioning(spark, monkeypatch):
    df, x, y = blobs(spark)
    test = is_test_mask(df, len(x))
    trainable = training.SoftmaxRegression(5, 3)
    params = np.random.default_rng(2).normal(size=(4, trainable.n_params))
    grads, losses = trainable.gradient(params, x[~test], y[~test])
    for partitions, block, tasks in ((1, None, None), (8, None, None), (8, None, 2), (3, 2, None)):
        if block:  # trials in blocks of two
            monkeypatch.setattr(training, "MAX_BROADCAST_BYTES", 8 * (trainable.n_params + 4) * block)
        got = training.training_pass(df.repartition(partitions), trainable, params, "x", "label", max_tasks=tasks)
        assert np.allclose(got.gradient, grads) and np.allclose(got.loss, losses)
        assert got.train_rows == (~test).sum() and got.test_rows == test.sum()
        assert np.array_equal(got.correct, trainable.correct(params, x[test], y[test]))


def test_model_too_large_for_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(training, "MAX_BROADCAST_BYTES", 8)
    df, _, _ = blobs(spark, n=10)
    with pytest.raises(ValueError, match="too large"):
        training.training_pass(df, training.SoftmaxRegression(5, 3), np.zeros((1, 18)), "x", "label")


def search_by_hand(x, y, test, trainable, lr, momentum, iterations):
    """Full-batch momentum descent, one trial at a time."""
    reports = {}
    for t in range(len(lr)):
        w, v = trainable.initial(np.array([t])), 0.0
        for i in range(1, iterations + 1):
            g = trainable.gradient(w, x[~test], y[~test])[0] / (~test).sum()
            v = momentum[t] * v + g
            w = w - lr[t] * v
            reports[t, i] = trainable.correct(w, x[test], y[test])[0] / test.sum()
    return reports


def trials_table(spark, lr, momentum):
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lr, momentum))]
    return spark.createDataFrame(rows, "trial_id long, lr double, momentum double")


def test_search_matches_training_by_hand(spark):
    df, x, y = blobs(spark)
    trainable = training.SoftmaxRegression(5, 3)
    lr, momentum = [0.001, 0.05, 0.5], [0.1, 0.5, 0.9]
    result = search.run_search(
        df, trials_table(spark, lr, momentum), trainable, key="id", features="x", label="label",
        max_iterations=4, target=2.0, horizon=None,
    )
    want = search_by_hand(x, y, is_test_mask(df, len(x)), trainable, lr, momentum, 4)
    got = {(r["trial_id"], r["training_iteration"]): r["mean_accuracy"] for r in result.metrics.collect()}
    assert got.keys() == want.keys()
    assert all(np.isclose(got[k], want[k]) for k in want)
    result.check_errors()
    best = result.best.first()
    last = {t: want[t, 4] for t in range(3)}
    assert best["trial_id"] == min(t for t in last if last[t] == max(last.values()))
    assert best["lr"] == lr[best["trial_id"]]


def test_search_stops_at_rungs(spark):
    df, _, _ = blobs(spark, noise=3.0)
    lr = [1e-6, 1e-5, 1e-4, 1e-3, 0.1, 1.0, 8.0, 20.0]
    result = search.run_search(
        df, trials_table(spark, lr, [0.1] * 8), training.SoftmaxRegression(5, 3),
        key="id", features="x", label="label", max_iterations=6, target=0.98, grace=2, reduction=4, horizon=100,
    )
    reports = result.metrics.toPandas()
    at_rung = reports[reports.training_iteration == 2]
    cut = np.quantile(at_rung.mean_accuracy, 0.75)
    later = set(reports[reports.training_iteration > 2].trial_id)
    assert later <= set(at_rung[at_rung.mean_accuracy >= cut].trial_id)
    assert len(later) < 8
    for _, trial in reports.sort_values("training_iteration").groupby("trial_id"):
        assert (trial.mean_accuracy.iloc[:-1] < 0.98).all()
        assert trial.training_iteration.tolist() == list(range(1, len(trial) + 1))


def test_tune_run_goes_on_to_the_horizon(spark, sf_dir):
    """The whole search against one in NumPy, with the rungs at 1, 4, 16 and 64 and the end at 100."""
    rows, trainable = plans._labelled(spark, sf_dir)
    samples = rows.collect()
    x, y = np.array([r["embedding"] for r in samples], float), np.array([r["label"] for r in samples])
    test = np.array([r["is_test"] for r in samples])
    drawn = search.param_space(spark).orderBy("trial_id").collect()
    lr, momentum = np.array([r["lr"] for r in drawn]), np.array([r["momentum"] for r in drawn])
    live, want = np.arange(len(drawn)), {}
    w = trainable.initial(live)
    v = np.zeros_like(w)
    for i in range(1, 101):
        g = trainable.gradient(w[live], x[~test], y[~test])[0] / (~test).sum()
        v[live] = momentum[live, None] * v[live] + g
        w[live] -= lr[live, None] * v[live]
        accuracy = trainable.correct(w[live], x[test], y[test]) / test.sum()
        want |= {(int(t), i): a for t, a in zip(live, accuracy)}
        keep = accuracy < 0.98
        if i in (1, 4, 16, 64):
            keep &= accuracy >= np.quantile(accuracy, 0.75)
        live = live[keep]
    assert max(i for _, i in want) == 100
    got = {(r["trial_id"], r["training_iteration"]): r["mean_accuracy"] for r in plans.tune_run(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert all(np.isclose(got[k], want[k], atol=1e-6) for k in want)


def test_search_stops_at_the_target(spark):
    df, _, _ = blobs(spark, noise=0.1)
    result = search.run_search(
        df, trials_table(spark, [0.1, 1.0], [0.1, 0.1]), training.SoftmaxRegression(5, 3),
        key="id", features="x", label="label", horizon=None,
    )
    assert {(r["trial_id"], r["training_iteration"]) for r in result.metrics.collect()} == {(0, 1), (1, 1)}


def test_horizon_ends_all_trials(spark):
    df, _, _ = blobs(spark, n=100)
    result = search.run_search(
        df, trials_table(spark, [0.01], [0.1]), training.SoftmaxRegression(5, 3),
        key="id", features="x", label="label", target=2.0, horizon=3,
    )
    assert result.metrics.count() == 3


def test_limits_of_a_search(spark, monkeypatch):
    df, _, _ = blobs(spark, n=100)
    trials = trials_table(spark, [0.1, 0.2], [0.1, 0.1])
    options = dict(key="id", features="x", label="label", mode="minibatch", max_iterations=1)
    monkeypatch.setattr(search, "MAX_BROADCAST_BYTES", 100)
    with pytest.raises(ValueError, match="too large"):
        search.run_search(df, trials, training.SoftmaxRegression(5, 3), **options)
    monkeypatch.setattr(search, "MAX_TRIALS", 1)
    with pytest.raises(ValueError, match="at most 1 trials"):
        search.run_search(df, trials, training.SoftmaxRegression(5, 3), **options)


@pytest.mark.parametrize("limit", [1 << 28, 100_000])
def test_minibatch_search_matches_training_by_hand(spark, monkeypatch, limit):
    monkeypatch.setattr(search, "MAX_BROADCAST_BYTES", limit)
    df, x, y = blobs(spark, n=1500)
    trainable = training.SoftmaxRegression(5, 3)
    sample_bytes = (576 + 320) * (5 + 1) * 8
    if limit < 1 << 28:  # room for one trial at a time
        monkeypatch.setattr(search, "MAX_BROADCAST_BYTES", sample_bytes + 16 * trainable.n_params + 1)
    lr, momentum = [0.01, 0.1], [0.2, 0.9]
    result = search.run_search(
        df, trials_table(spark, lr, momentum), trainable, key="id", features="x", label="label",
        mode="minibatch", max_iterations=2, target=2.0, horizon=None,
    )
    import hashlib

    test = is_test_mask(df, len(x))

    def first(seed, mask, n):
        ids = np.flatnonzero(mask)
        return sorted(ids, key=lambda i: hashlib.md5(f"{seed}-{i}".encode()).hexdigest())[:n]

    got = {(r["trial_id"], r["training_iteration"]): r["mean_accuracy"] for r in result.metrics.collect()}
    for t in range(2):
        w, v = np.zeros((1, trainable.n_params)), 0.0
        for i in (1, 2):
            rows = first(f"train-{i}", ~test, 576)
            assert len(rows) == 576
            for b in range(0, 576, 64):
                part = rows[b : b + 64]
                v = momentum[t] * v + trainable.gradient(w, x[part], y[part])[0] / 64
                w = w - lr[t] * v
            rows = first(f"test-{i}", test, 320)
            assert np.isclose(got[t, i], trainable.correct(w, x[rows], y[rows])[0] / len(rows))


def test_failing_trials_are_reported(spark):
    class Failing(training.SoftmaxRegression):
        def gradient(self, params, x, y):
            if abs(params).max() > 0:
                raise RuntimeError("no second step")
            return super().gradient(params, x, y)

    df, _, _ = blobs(spark)
    result = search.run_search(
        df, trials_table(spark, [0.1, 0.2], [0.1, 0.1]), Failing(5, 3), key="id", features="x", label="label",
        mode="minibatch", max_iterations=3,
    )
    assert search.trial_errors(result.metrics).first().asDict() == {"trials": 2, "errors": 2, "ok": False}
    with pytest.raises(RuntimeError, match="trials with errors"):
        result.check_errors()


def test_checkpoints_and_resume(spark, tmp_path):
    df, _, _ = blobs(spark)
    trainable = training.SoftmaxRegression(5, 3)
    trials = trials_table(spark, [0.01, 0.1, 0.5], [0.2, 0.9, 0.5])
    options = dict(key="id", features="x", label="label", target=2.0, horizon=None)
    whole = search.run_search(df, trials, trainable, max_iterations=4, **options)
    path = str(tmp_path / "state")
    assert checkpoints.latest(spark, path) is None
    search.run_search(df, trials, trainable, max_iterations=2, checkpoint_path=path, **options)
    state = checkpoints.latest(spark, path)
    assert state.iteration == 2 and state.params.shape == (3, 18)
    changed = trials_table(spark, [0.02, 0.1, 0.5], [0.2, 0.9, 0.5])
    with pytest.raises(ValueError, match="other parameters"):
        search.run_search(df, changed, trainable, max_iterations=4, checkpoint_path=path, resume=True, **options)
    with pytest.raises(ValueError, match="other trials"):
        search.run_search(df, changed.limit(2), trainable, max_iterations=4, checkpoint_path=path, resume=True, **options)
    rest = search.run_search(df, trials, trainable, max_iterations=4, checkpoint_path=path, resume=True, **options)
    assert [r[:2] for r in rest.reports] == [r[:2] for r in whole.reports]
    assert np.allclose([r[2] for r in rest.reports], [r[2] for r in whole.reports])
    assert all(np.allclose(rest.params[t], whole.params[t]) for t in range(3))
    assert checkpoints.read(spark, path).count() == 4 * 3 * 18


def test_split_is_stable_and_near_its_share(spark):
    df = sampling.split_train_test(spark.range(5000), "id")
    share = df.agg(F.avg(F.col("is_test").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.02
    again = sampling.split_train_test(spark.range(5000).repartition(7), "id")
    assert df.exceptAll(again).count() == 0


def test_epoch_rows():
    assert sampling.rows_within_cap(512) == 576
    assert sampling.rows_within_cap(256) == 320
    assert sampling.rows_within_cap(0) == 64


def test_epoch_sample_is_the_start_of_the_hash_order(spark):
    import hashlib

    want = sorted(range(20000), key=lambda i: hashlib.md5(f"epoch-{i}".encode()).hexdigest())[:576]
    rows = sampling.epoch_sample(spark.range(20000), "id").collect()
    assert {(r["id"], r["batch_index"]) for r in rows} == {(v, i // 64) for i, v in enumerate(want)}
    small = sampling.epoch_sample(spark.range(100), "id")
    assert small.count() == 100 and small.agg(F.max("batch_index")).first()[0] == 1


def test_sample_falls_back_when_the_bound_keeps_too_few(spark, monkeypatch):
    monkeypatch.setattr(sampling, "likely_rows", lambda df, *_: df.filter("id < 3"))
    assert sampling.hash_sample(spark.range(1000), "id", 50, "s").count() == 50


def test_shuffle_keeps_all_rows(spark):
    shuffled = sampling.shuffle_rows(spark.range(1000), "id", "s", partitions=4)
    rows = [r["id"] for r in shuffled.collect()]
    assert sorted(rows) == list(range(1000)) and rows != sorted(rows)


@pytest.mark.parametrize("label", [-1, 3, None])
def test_labels_outside_the_classes_are_errors(spark, label):
    df = spark.createDataFrame([(1, [0.1] * 5, 0, False), (2, [0.2] * 5, label, False)], "id long, x array<float>, y int, is_test boolean")
    with pytest.raises(Exception, match="labels in y"):
        training.training_pass(df, training.SoftmaxRegression(5, 3), np.zeros((1, 18)), "x", "y")


def test_sums_do_not_depend_on_the_number_of_splits(spark):
    df, _, _ = blobs(spark, n=600)
    trainable = training.SoftmaxRegression(5, 3)
    params = trainable.initial(np.arange(2))
    one = training.training_pass(df.coalesce(1), trainable, params, "x", "label")
    many = training.training_pass(df.repartition(500), trainable, params, "x", "label")
    assert np.allclose(one.gradient, many.gradient) and one.train_rows == many.train_rows and one.test_rows == many.test_rows


def test_a_failing_trial_leaves_the_others_in_full_mode(spark):
    class Failing(training.SoftmaxRegression):
        def gradient(self, params, x, y):
            if (abs(params).max(axis=1) > 5).any():
                raise RuntimeError("diverged")
            return super().gradient(params, x, y)

    df, _, _ = blobs(spark)
    result = search.run_search(
        df, trials_table(spark, [0.1, 1e4], [0.1, 0.1]), Failing(5, 3), key="id", features="x", label="label",
        max_iterations=4, target=2.0, horizon=None,
    )
    reports = {(r[0], r[1]): r[3] for r in result.reports}
    assert all(reports[0, i] is None for i in range(1, 5))
    assert any(e for (t, _), e in reports.items() if t == 1)


def test_minibatch_samples_of_a_block_come_from_one_scan(spark, monkeypatch):
    scans = []
    drawn = sampling.samples_of_iterations
    monkeypatch.setattr(sampling, "samples_of_iterations", lambda *a: scans.append(a[2]) or drawn(*a))
    df, _, _ = blobs(spark, n=400)
    search.run_search(
        df, trials_table(spark, [0.01], [0.2]), training.SoftmaxRegression(5, 3), key="id", features="x", label="label",
        mode="minibatch", max_iterations=6, target=2.0, horizon=None,
    )
    assert [sorted(s) for s in scans] == [[f"train-{i}" for i in range(1, 7)], [f"test-{i}" for i in range(1, 7)]] or len(scans) == 2

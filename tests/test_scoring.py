import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.operators import batches, evaluation, models, scoring

WEIGHTS = np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 1.0], [0.0, 0.0], [-1.0, 0.0], [0.0, -1.0]])
MODEL = models.LinearModel(WEIGHTS, np.zeros(6))


def frame(spark, rows, schema="id long, x array<float>, path string"):
    return spark.createDataFrame(rows, schema)


def run(df, **options):
    options = {"keep": ["id"], **options}
    return scoring.score(df, lambda: MODEL, scoring.vector_features("x", 2), **options)


def test_scores_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)).astype(np.float32)
    df = frame(spark, [(i, v.tolist(), f"d/{i}.png") for i, v in enumerate(x)])
    want = scoring.probabilities(x.astype(float) @ WEIGHTS.T)
    for partitions, batch in ((1, 32), (8, 7), (3, 1000)):
        rows = run(df.repartition(partitions), batch_size=batch).orderBy("id").collect()
        assert len(rows) == 200
        for r, p in zip(rows, want):
            order = np.argsort(-p, kind="stable")
            assert r["predicted_class"] == order[0] == r["top_5_classes"][0]
            assert r["top_5_classes"] == order[:5].tolist()
            assert np.allclose(r["top_5_scores"], p[order[:5]])
            assert r["confidence_score"] == r["top_5_scores"][0]
            assert r["top_5_scores"] == sorted(r["top_5_scores"], reverse=True)
            assert r["error"] is None
            assert r["file_path"] == f"d/{r['id']}.png"


def test_missing_path_column_gives_null(spark):
    df = frame(spark, [(1, [1.0, 2.0], "p")]).drop("path")
    assert run(df).first()["file_path"] is None


BROKEN = [(1, [1.0, 2.0], "a"), (2, None, "b"), (3, [1.0], "c"), (4, [None, 1.0], "d"), (5, [3.0, 4.0], None)]


def test_broken_rows_are_scored_as_zeros_and_reported(spark):
    rows = {r["id"]: r for r in run(frame(spark, BROKEN).coalesce(1)).collect()}
    assert set(rows) == {1, 2, 3, 4, 5}
    for i in (2, 3, 4):
        assert rows[i]["error"]
        assert rows[i]["predicted_class"] == 0
        assert np.isclose(rows[i]["confidence_score"], 1 / 6)
        assert rows[i]["top_5_classes"] == [0, 1, 2, 3, 4]
    assert rows[1]["error"] is None and rows[5]["predicted_class"] == 2


def test_broken_rows_as_nulls(spark):
    rows = {r["id"]: r for r in run(frame(spark, BROKEN).coalesce(1), on_error="null").collect()}
    assert rows[2]["predicted_class"] is None and rows[2]["top_5_classes"] is None and rows[2]["top_5_scores"] is None
    assert rows[1]["predicted_class"] == 2 and len(rows[1]["top_5_scores"]) == 5
    assert rows[5]["top_5_classes"][0] == 2


def test_broken_rows_as_failure(spark):
    with pytest.raises(Exception, match="unusable features"):
        run(frame(spark, BROKEN), on_error="fail").collect()
    with pytest.raises(ValueError):
        run(frame(spark, BROKEN), on_error="ignore")
    with pytest.raises(ValueError):
        run(frame(spark, BROKEN), batch_size=0)


def test_logits(spark):
    got = scoring.score_logits(frame(spark, BROKEN).coalesce(1), lambda: MODEL, scoring.vector_features("x", 2), keep=["id"])
    rows = {r["id"]: r["logits"] for r in got.collect()}
    assert rows[1] == (WEIGHTS @ [1, 2]).tolist() and rows[5] == (WEIGHTS @ [3, 4]).tolist()
    assert rows[2] is rows[3] is rows[4] is None


def test_empty_input(spark):
    assert run(frame(spark, [])).count() == 0


def test_fewer_classes_than_ranks(spark):
    model = models.LinearModel(WEIGHTS[:2], np.zeros(2))
    row = scoring.score(frame(spark, [(1, [2.0, 1.0], "p")]), lambda: model, scoring.vector_features("x", 2)).first()
    assert row["top_5_classes"] == [0, 1]


def test_models_load_once_per_task(spark):
    loads = spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        return MODEL

    df = frame(spark, [(i, [1.0, 2.0], "p") for i in range(100)]).repartition(2)
    scoring.score(df, load, scoring.vector_features("x", 2), batch_size=4).write.format("noop").mode("overwrite").save()
    assert loads.value == 2


def test_linear_scoring_matches_the_model(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 2))
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    bias = np.array([0.5, 0, 0, -1.0, 0, 2.0])
    cells = [(k, p, float(WEIGHTS[k, p])) for k in range(6) for p in range(2)] + [(k, -1, float(bias[k])) for k in range(6)]
    weights = spark.createDataFrame(cells, "class_id int, pos int, weight double")
    model = models.linear_model(weights)
    assert np.array_equal(model.weights, WEIGHTS) and np.array_equal(model.bias, bias)
    want = model.logits(x)
    got = {r["id"]: r for r in scoring.score_linear(df, weights, features="x", keep=["id"]).collect()}
    probs = scoring.probabilities(want)
    assert len(got) == 50
    for i, row in got.items():
        assert np.allclose(row["top_5_scores"], np.sort(probs[i])[::-1][:5])


def test_class_means(spark):
    df = frame(spark, [(1, [1.0, 2.0]), (1, [3.0, 4.0]), (0, [5.0, 6.0])], "label int, x array<float>")
    got = {(r["class_id"], r["pos"]): r["weight"] for r in scoring.class_means(df, "x", "label").collect()}
    assert got == {(1, 0): 2.0, (1, 1): 3.0, (0, 0): 5.0, (0, 1): 6.0}


CELLS = [(k, p, float(WEIGHTS[k, p])) for k in range(6) for p in range(2)]


def test_weights_in_blocks_give_the_same_rows(spark, monkeypatch):
    cells = CELLS + [(k, -1, k / 10) for k in range(6)]
    weights = spark.createDataFrame(cells, "class_id int, pos int, weight double")
    odd = [(7, [float("nan"), 1.0], "g"), (8, [float("inf"), 1.0], "h"), (1, [0.5, 0.25], "a"), (None, [2.0, 1.0], "n")]
    df = frame(spark, [*BROKEN, (6, [0.5, -3.0], "f"), *odd]).withColumn("extra", F.col("id") * 2)

    def run_all():
        found = []
        for mode in ("zero", "null"):
            rows = scoring.score_linear(df, weights, features="x", keep=["id", "extra"], on_error=mode).collect()
            found.append(sorted(rows, key=lambda r: (str(r["id"]), str(r["confidence_score"]))))
        return found

    one_block = run_all()
    for classes in (1, 2, 4):
        monkeypatch.setattr(models, "MAX_BROADCAST_BYTES", 8 * 3 * classes)
        for want, got in zip(one_block, run_all(), strict=True):
            assert len(want) == len(got) == 10
            for a, b in zip(want, got, strict=True):
                for name in ("id", "extra", "predicted_class", "top_5_classes", "file_path", "error"):
                    assert a[name] == b[name]
                if a["top_5_scores"] is not None:
                    assert np.allclose(a["top_5_scores"], b["top_5_scores"]) and np.isclose(a["confidence_score"], b["confidence_score"])
    broken = {r["file_path"] for r in one_block[0] if r["error"]}
    assert broken == {"b", "c", "d", "g", "h"}
    with pytest.raises(Exception, match="unusable features"):
        scoring.score_linear(df, weights, features="x", on_error="fail").collect()
    monkeypatch.setattr(models, "MAX_BROADCAST_BYTES", 8)
    with pytest.raises(ValueError, match="one class"):
        scoring.score_linear(df, weights, features="x")


def test_classes_with_gaps(spark, monkeypatch):
    weights = spark.createDataFrame([(3, 0, 1.0), (3, 1, 0.0), (7, 0, 0.0), (7, 1, 1.0)], "class_id int, pos int, weight double")
    df = frame(spark, [(1, [2.0, 1.0], "p"), (2, [1.0, 2.0], "q"), (3, [1.0, 1.0], "r")])

    def top():
        return {r["id"]: r["top_5_classes"] for r in scoring.score_linear(df, weights, features="x", keep=["id"]).collect()}

    want = {1: [3, 7], 2: [7, 3], 3: [3, 7]}
    assert top() == want
    model = models.linear_model(weights)
    logits = scoring.score_logits(df, lambda: model, scoring.vector_features("x", 2), keep=["id"]).filter("id = 1").first()["logits"]
    assert logits[3] == 2.0 and logits[7] == 1.0 and logits[0] == -np.inf and len(logits) == 8
    monkeypatch.setattr(models, "MAX_BROADCAST_BYTES", 8 * 3)
    assert top() == want


def test_weights_are_checked_for_size(spark, monkeypatch):
    weights = spark.createDataFrame(CELLS, "class_id int, pos int, weight double")
    assert np.array_equal(models.linear_model(weights).weights, WEIGHTS)
    monkeypatch.setattr(models, "MAX_BROADCAST_BYTES", 8 * 11)
    with pytest.raises(ValueError, match="too large"):
        models.linear_model(weights)
    with pytest.raises(ValueError, match="empty"):
        models.linear_model(weights.limit(0))
    listed = type("Listed", (), {"logits": None})()
    listed.cells = [0.5] * 100_000
    with pytest.raises(ValueError, match="too large to broadcast"):
        models.broadcast_loader(spark, listed)


def test_registry_checks_names_on_the_driver():
    registry = models.ModelRegistry()
    with pytest.raises(ValueError, match="'other' is none of the declared models"):
        registry.loader("other")
    with pytest.raises(ValueError, match="no weights registered"):
        registry.loader("resnet18")
    registry.register("resnet18", lambda: MODEL)
    assert registry.loader("resnet18")() is MODEL


def test_conv_model_by_hand():
    from kilnwork.operators.training import ConvClassifier

    net = ConvClassifier()
    assert net.n_params == 1960
    flat = np.random.default_rng(3).normal(size=1960)
    model = net.model(flat)
    x = np.random.default_rng(4).normal(size=(2, 28, 28))
    got = model.logits(x)
    assert np.allclose(got, model.logits(x.reshape(2, -1)))
    for n in range(2):
        hidden = []
        for f in range(3):
            maps = np.array(
                [[(x[n, i : i + 3, j : j + 3] * model.kernels[f]).sum() + model.kernel_bias[f] for j in range(26)] for i in range(26)]
            )
            hidden += [max(maps[3 * i : 3 * i + 3, 3 * j : 3 * j + 3].max(), 0) for i in range(8) for j in range(8)]
        assert np.allclose(got[n], model.weights @ hidden + model.bias)


def test_map_batches_and_fanout(spark):
    import pyarrow as pa

    def double(batch):
        return pa.RecordBatch.from_arrays([pa.array([2 * v.as_py() for v in batch.column(0)], pa.int64())], ["id"])

    assert sorted(r[0] for r in batches.map_batches(spark.range(10), double, "id long", batch_size=3).collect()) == list(
        range(0, 20, 2)
    )
    assert {r["result"] for r in batches.fanout(spark.range(5), lambda: "hi").collect()} == {"hi"}
    squares = batches.fanout(spark.range(5), lambda i: i * i, "id", column="square", kind="bigint")
    assert {(r["id"], r["square"]) for r in squares.collect()} == {(i, i * i) for i in range(5)}
    df = spark.range(3)
    batches.fanout(df, lambda: "hi")
    assert df.columns == ["id"]


def test_gpu_profile(spark):
    assert batches.gpu_profile(0) is None
    assert batches.gpu_profile(0.5).taskResources["gpu"].amount == 0.5
    assert batches.gpu_profile(2).executorResources["gpu"].amount == 2


def test_spread_only_adds_partitions(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 50)
    assert batches.spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert batches.spread(many) is many


def test_accuracy_and_loss(spark):
    df = frame(spark, [(1, 1), (2, 0), (3, 3), (4, 4)], "predicted_class int, label int")
    assert evaluation.accuracy(df).first().asDict() == {"correct": 3, "total": 4, "accuracy": 0.75}
    empty = df.filter("label > 9")
    assert evaluation.accuracy(empty).first()["accuracy"] is None
    with pytest.raises(ValueError):
        evaluation.accuracy_value(empty)
    logits = frame(spark, [([0.0, 0.0], 1), ([0.0, 0.0], 0)], "z array<double>, label int")
    assert np.isclose(evaluation.mean_nll(logits, "z").first()["mean_nll"], np.log(2))
    targets = frame(spark, [(1, 1), (2, 2)], "id long, label int")
    predictions = frame(spark, [(2, 2), (1, 0), (3, 3)], "id long, predicted_class int")
    assert evaluation.accuracy_value(evaluation.pair_with_targets(predictions, targets, "id")) == 0.5


def test_scan_reads_only_the_needed_columns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").filter(F.col("vec_id") > 5)
    plan = scoring.score(df, lambda: MODEL, scoring.vector_features("embedding", 64), keep=["vec_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text
    assert "GreaterThan(vec_id,5)" in text
    assert "Exchange" not in text

"""Training and hyper-parameter search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kilnwork.operators import async_halving, sampling, search, training, workers
from kilnwork.plans.inputs import METRICS_SQL, event_metrics, samples, table
from kilnwork.session import materialise, scratch_path
from kilnwork.sinks import checkpoints


# Starting weights lie within this distance of zero, so that trials differ from the first report on.
_START = 0.1
# Iterations of the search that SQL checks: beyond three rungs, and few enough for that SQL.
_TUNE_ITERATIONS = 20
# Where the search that is taken up again ends first: between two rungs.
_ENDED_AT = 7


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, training.SoftmaxRegression]:
    rows = samples(spark, sf_dir)
    shape = rows.agg(F.max("label").alias("k"), F.max(F.size("embedding")).alias("d")).first()
    return sampling.split_train_test(rows, "vec_id"), training.SoftmaxRegression(shape["d"], shape["k"] + 1, _START)


def gradient_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean gradient over the training rows at zero weights; position ``d`` is the bias."""
    rows, trainable = _labelled(spark, sf_dir)
    zeros = spark.sparkContext.broadcast(np.zeros((1, trainable.n_params)))
    sums = training.partial_sums(rows, trainable, zeros, "embedding", "label")
    # The row count comes out of the same pass, at its own position.
    n = trainable.n_params
    rows_used = F.max(F.when(F.col("pos") == n + 1, F.col("value"))).over(Window.partitionBy("trial"))
    return (
        sums.withColumn("rows", rows_used)
        .filter(F.col("pos") < n)
        .select(
            (F.col("pos") % trainable.classes).cast("int").alias("class_id"),
            F.floor(F.col("pos") / trainable.classes).cast("int").alias("pos"),
            F.round(F.col("value") / F.col("rows"), 6).alias("gradient"),
        )
    )


def _search(spark: SparkSession, sf_dir: str, **options) -> search.SearchResult:
    rows, trainable = _labelled(spark, sf_dir)
    return search.run_search(
        rows,
        search.param_space(spark, options.pop("num_trials", search.NUM_TRIALS)),
        trainable,
        key="vec_id",
        features="embedding",
        label="label",
        **{"max_iterations": search.MAX_ITERATIONS, **options},
    )


def _accuracies(result: search.SearchResult) -> DataFrame:
    result.check_errors()
    return result.metrics.select("trial_id", "training_iteration", F.round("mean_accuracy", 6).alias("mean_accuracy"))


def tune_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole search: trials end at a rung, at the target or at the horizon. A NumPy version checks it in the tests."""
    return _accuracies(_search(spark, sf_dir))


def tune_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first iterations of the same search, with the rungs at 1, 4 and 16, which SQL checks."""
    return _accuracies(_search(spark, sf_dir, max_iterations=_TUNE_ITERATIONS))


def tune_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same iterations with a checkpoint after each, ended after the seventh and taken up again from the last one."""
    path = scratch_path(spark, "search")
    _search(spark, sf_dir, max_iterations=_ENDED_AT, checkpoint_path=path)
    return _accuracies(_search(spark, sf_dir, max_iterations=_TUNE_ITERATIONS, checkpoint_path=path, resume=True))


def tune_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same iterations where no trial waits at a rung: each is compared with the reports before its own."""
    return _accuracies(_search(spark, sf_dir, max_iterations=_TUNE_ITERATIONS, rule=async_halving.arrival_rule()))


def tune_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = {"num_trials": search.SMOKE_TRIALS, "max_iterations": search.SMOKE_ITERATIONS}
    return _accuracies(_search(spark, sf_dir, **options))


def tune_minibatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accuracies(_search(spark, sf_dir, mode="minibatch", max_iterations=search.SMOKE_ITERATIONS))


def checkpoint_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "search")
    _search(spark, sf_dir, num_trials=4, max_iterations=search.SMOKE_ITERATIONS, horizon=None, checkpoint_path=path)
    return checkpoints.read(spark, path).select(
        "trial_id", "training_iteration", "param_index", F.round("value", 6).alias("value"), "live"
    )


def train_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four trials trained by two workers that stay up: the parameters after each of five steps."""
    rows, trainable = _labelled(spark, sf_dir)
    steps = workers.train_workers(
        rows, search.param_space(spark, 4), trainable, features="embedding", label="label", steps=search.SMOKE_ITERATIONS, workers=2
    )
    cells = steps.select("trial_id", F.col("step").alias("training_iteration"), F.posexplode("params").alias("param_index", "value"))
    return cells.withColumn("value", F.round("value", 6))


def param_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user who has events as one trial."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("trial_id")).distinct()
    return search.draw_params(users).select(
        "trial_id", F.round("lr", 10).alias("lr"), F.round("momentum", 8).alias("momentum")
    )


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.report_metrics(event_metrics(spark, sf_dir), "correct", "total")


def trial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir).withColumn("mean_accuracy", F.round("mean_accuracy", 6))


def asha_rungs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rungs = search.halving_rungs(materialise(_reports(spark, sf_dir), "reports"))
    return rungs.select(
        "trial_id",
        "training_iteration",
        F.round("mean_accuracy", 6).alias("mean_accuracy"),
        F.round("cut", 6).alias("cut"),
        "keep",
    )


def _stop_rule(target: float, max_iterations: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        kept = search.until_stopped(_reports(spark, sf_dir), target, max_iterations)
        return kept.select(
            "trial_id",
            "training_iteration",
            F.round("mean_accuracy", 6).alias("mean_accuracy"),
            F.coalesce("stop_iteration", F.lit(0)).alias("stop_iteration"),
        )

    return run


def _best(scope: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = _reports(spark, sf_dir)
        params = search.draw_params(table(spark, sf_dir, "events").select(F.col("user_id").alias("trial_id")).distinct())
        return search.best_trial(metrics, params, scope).select(
            "trial_id",
            "training_iteration",
            F.round("mean_accuracy", 6).alias("mean_accuracy"),
            F.round("lr", 10).alias("lr"),
            F.round("momentum", 8).alias("momentum"),
        )

    return run


def trial_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial has failed if its user has an event of type ``error``."""
    failed = F.max(F.when(F.col("event_type") == "error", F.lit("failed")))
    trials = table(spark, sf_dir, "events").groupBy("user_id").agg(failed.alias("error"))
    return search.trial_errors(trials)


QUERIES = {
    "gradient_step": gradient_step,
    "tune_run": tune_run,
    "tune_rungs": tune_rungs,
    "tune_resumed": tune_resumed,
    "tune_async": tune_async,
    "tune_smoke": tune_smoke,
    "tune_minibatch": tune_minibatch,
    "checkpoint_roundtrip": checkpoint_roundtrip,
    "train_workers": train_workers,
    "param_space": param_space,
    "trial_metrics": trial_metrics,
    "asha_rungs": asha_rungs,
    "stop_rule": _stop_rule(search.TARGET_ACCURACY, search.MAX_ITERATIONS),
    "stop_rule_smoke": _stop_rule(search.TARGET_ACCURACY, search.SMOKE_ITERATIONS),
    "best_trial": _best("last"),
    "best_trial_all": _best("all"),
    "trial_errors": trial_errors,
}


def _draw(seed: str) -> str:
    return f"('0x' || left(md5('{seed}-' || trial_id), 8))::BIGINT / 4294967296.0::DOUBLE"


_PARAMS = f"""
    SELECT trial_id,
           round(exp(ln(1e-4::DOUBLE) + {_draw('lr')} * (ln(1e-2::DOUBLE) - ln(1e-4::DOUBLE))), 10) AS lr,
           round(0.1::DOUBLE + {_draw('momentum')} * 0.8::DOUBLE, 8) AS momentum
    FROM (SELECT DISTINCT user_id AS trial_id FROM events)
"""


def _stop_sql(max_iterations: int) -> str:
    return f"""
        WITH m AS ({METRICS_SQL}),
        s AS (SELECT trial_id, min(training_iteration) FILTER
                  (mean_accuracy >= {search.TARGET_ACCURACY} OR training_iteration >= {max_iterations}) AS stop_iteration
              FROM m GROUP BY 1)
        SELECT trial_id, training_iteration::INT AS training_iteration,
               round(mean_accuracy, 6) AS mean_accuracy, coalesce(stop_iteration, 0)::INT AS stop_iteration
        FROM m JOIN s USING (trial_id) WHERE stop_iteration IS NULL OR training_iteration <= stop_iteration
    """


def _best_sql(rows: str) -> str:
    return f"""
        WITH m AS ({METRICS_SQL}), p AS ({_PARAMS}), rows AS ({rows})
        SELECT trial_id, training_iteration::INT AS training_iteration,
               round(mean_accuracy, 6) AS mean_accuracy, lr, momentum
        FROM rows JOIN p USING (trial_id)
        ORDER BY rows.mean_accuracy DESC, trial_id, training_iteration LIMIT 1
    """


def _start_sql(trials: int) -> str:
    return f"""WITH
    s AS MATERIALIZED (SELECT vec_id, label, left(md5('split-' || vec_id), 8) < '33333333' AS is_test,
                              list_append(embedding::DOUBLE[], 1.0) AS x FROM embeddings),
    n AS (SELECT max(label) + 1 AS classes, max(len(x)) AS width FROM s),
    t AS MATERIALIZED (
        SELECT trial_id, exp(ln(1e-4::DOUBLE) + {_draw('lr')} * (ln(1e-2::DOUBLE) - ln(1e-4::DOUBLE))) AS lr,
               0.1::DOUBLE + {_draw('momentum')} * 0.8::DOUBLE AS momentum
        FROM (SELECT unnest(range({trials})) AS trial_id)),
    w0 AS (SELECT trial_id, class_id, pos, 0.0::DOUBLE AS v, {_START}::DOUBLE * (2 *
             (('0x' || left(md5('start-' || trial_id || '-' || (pos * classes + class_id)), 8))::BIGINT::DOUBLE / 4294967296)
             - 1) AS w FROM t, n,
           (SELECT unnest(range(classes)) AS class_id FROM n), (SELECT unnest(range(width)) AS pos FROM n)),
    live0 AS (SELECT trial_id FROM t)"""


def _descend_sql(step: int, rows: str, iteration: int) -> str:
    """``w<step + 1>`` from ``w<step>`` by the mean gradient over ``rows``, for the trials going on."""
    return f"""
    d{step} AS MATERIALIZED (SELECT vec_id, label, x FROM {rows}),
    z{step} AS (
        SELECT trial_id, vec_id, label, class_id, list_dot_product(x, ws) AS z
        FROM d{step}, (SELECT trial_id, class_id, list(w ORDER BY pos) AS ws
                       FROM w{step} JOIN live{iteration - 1} USING (trial_id) GROUP BY 1, 2)),
    g{step} AS (
        SELECT trial_id, class_id, pos, sum(p * u) / (SELECT count(*) FROM d{step}) AS g
        FROM (SELECT trial_id, vec_id, class_id,
                     power / sum(power) OVER (PARTITION BY trial_id, vec_id) - (class_id = label)::INT AS p
              FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY trial_id, vec_id)) AS power FROM z{step}))
        JOIN (SELECT vec_id, unnest(x) AS u, unnest(range(len(x))) AS pos FROM d{step}) USING (vec_id)
        GROUP BY 1, 2, 3),
    w{step + 1} AS MATERIALIZED (
        SELECT trial_id, class_id, pos, CASE WHEN g IS NULL THEN w ELSE w - lr * (momentum * v + g) END AS w,
               CASE WHEN g IS NULL THEN v ELSE momentum * v + g END AS v
        FROM w{step} JOIN live{iteration - 1} USING (trial_id) LEFT JOIN g{step} USING (trial_id, class_id, pos)
        JOIN t USING (trial_id))"""


def _report_sql(iteration: int, step: int, rows: str, rungs: tuple[int, ...], waiting: bool = True) -> str:
    """``acc<iteration>`` of ``w<step>`` on ``rows``, and the trials that go on."""
    cut = f" AND mean_accuracy >= (SELECT quantile_cont(mean_accuracy, 0.75) FROM acc{iteration})"
    if not waiting:
        before = "quantile_cont(mean_accuracy, 0.75) OVER (ORDER BY trial_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        cut = f" QUALIFY coalesce(mean_accuracy >= {before}, true)"
    return f"""
    acc{iteration} AS MATERIALIZED (
        SELECT trial_id, {iteration} AS training_iteration, avg((best = label)::INT) AS mean_accuracy
        FROM (SELECT trial_id, vec_id, any_value(label) AS label,
                     arg_min(class_id, (-list_dot_product(x, ws), class_id)) AS best
              FROM {rows}, (SELECT trial_id, class_id, list(w ORDER BY pos) AS ws FROM w{step} GROUP BY 1, 2)
              GROUP BY 1, 2) GROUP BY 1),
    live{iteration} AS (SELECT trial_id FROM (SELECT * FROM acc{iteration}{cut if iteration in rungs and not waiting else ""})
        WHERE mean_accuracy < {search.TARGET_ACCURACY}{cut if iteration in rungs and waiting else ""})"""


def _descent_sql(trials: int, iterations: int, rungs: tuple[int, ...], waiting: bool = True) -> str:
    """A search of full passes: parameters ``w<i>`` and accuracies ``acc<i>`` of each iteration."""
    parts = [_start_sql(trials)]
    for i in range(1, iterations + 1):
        parts.append(_descend_sql(i - 1, "s WHERE NOT is_test", i))
        parts.append(_report_sql(i, i, "(FROM s WHERE is_test)", rungs, waiting))
    return ",".join(parts)


def _minibatch_sql(trials: int, iterations: int, rungs: tuple[int, ...]) -> str:
    """The same with a capped sample in mini-batches for each iteration."""
    parts = [_start_sql(trials)]
    size = sampling.BATCH_SIZE
    train, test = sampling.rows_within_cap(sampling.EPOCH_CAP), sampling.rows_within_cap(sampling.TEST_CAP)
    batches = train // size
    for i in range(1, iterations + 1):
        for name, rows, n in (("train", "NOT is_test", train), ("test", "is_test", test)):
            order = f"row_number() OVER (ORDER BY md5('{name}-{i}-' || vec_id), vec_id)"
            parts.append(f"""
    {name}{i} AS MATERIALIZED (SELECT *, ({order} - 1) // {size} AS batch FROM s WHERE {rows} QUALIFY {order} <= {n})""")
        for b in range(batches):
            parts.append(_descend_sql((i - 1) * batches + b, f"train{i} WHERE batch = {b}", i))
        parts.append(_report_sql(i, i * batches, f"test{i}", rungs))
    return ",".join(parts)


def _all(iterations: int, select: str) -> str:
    return " UNION ALL ".join(select.format(i=i) for i in range(1, iterations + 1))


ORACLES = {
    "tune_async": _descent_sql(search.NUM_TRIALS, _TUNE_ITERATIONS, (1, 4, 16), waiting=False)
    + _all(
        _TUNE_ITERATIONS,
        " SELECT trial_id, training_iteration, round(mean_accuracy, 6) AS mean_accuracy FROM acc{i}",
    ),
    "tune_resumed": _descent_sql(search.NUM_TRIALS, _TUNE_ITERATIONS, (1, 4, 16))
    + _all(
        _TUNE_ITERATIONS,
        " SELECT trial_id, training_iteration, round(mean_accuracy, 6) AS mean_accuracy FROM acc{i}",
    ),
    "tune_rungs": _descent_sql(search.NUM_TRIALS, _TUNE_ITERATIONS, (1, 4, 16))
    + _all(
        _TUNE_ITERATIONS,
        " SELECT trial_id, training_iteration, round(mean_accuracy, 6) AS mean_accuracy FROM acc{i}",
    ),
    "tune_smoke": _descent_sql(search.SMOKE_TRIALS, search.SMOKE_ITERATIONS, ())
    + _all(
        search.SMOKE_ITERATIONS,
        " SELECT trial_id, training_iteration, round(mean_accuracy, 6) AS mean_accuracy FROM acc{i}",
    ),
    "tune_minibatch": _minibatch_sql(search.NUM_TRIALS, search.SMOKE_ITERATIONS, (1, 4))
    + _all(
        search.SMOKE_ITERATIONS,
        " SELECT trial_id, training_iteration, round(mean_accuracy, 6) AS mean_accuracy FROM acc{i}",
    ),
    "checkpoint_roundtrip": _descent_sql(4, search.SMOKE_ITERATIONS, ())
    + _all(
        search.SMOKE_ITERATIONS,
        " SELECT trial_id, {i} AS training_iteration, (pos * classes + class_id)::INT AS param_index,"
        " round(w, 6) AS value, true AS live FROM w{i}, n",
    ),
    "train_workers": _descent_sql(4, search.SMOKE_ITERATIONS, ())
    + _all(
        search.SMOKE_ITERATIONS,
        " SELECT trial_id, {i} AS training_iteration, (pos * classes + class_id)::INT AS param_index,"
        " round(w, 6) AS value FROM w{i}, n",
    ),
    "gradient_step": """
        WITH n AS (SELECT vec_id, label, list_append(embedding::DOUBLE[], 1.0) AS v FROM embeddings
                   WHERE left(md5('split-' || vec_id), 8) >= '33333333'),
        x AS (SELECT label, unnest(v) AS v, unnest(range(len(v)))::INT AS pos FROM n),
        k AS (SELECT unnest(range((SELECT max(label) + 1 FROM embeddings)))::INT AS class_id),
        c AS (SELECT count(*) AS classes FROM k)
        SELECT class_id, pos, round(avg((1.0::DOUBLE / classes - (label = class_id)::INT) * v), 6) AS gradient
        FROM x, k, c GROUP BY 1, 2
    """,
    "param_space": _PARAMS,
    "trial_metrics": f"""
        SELECT trial_id, training_iteration::INT AS training_iteration, round(mean_accuracy, 6) AS mean_accuracy
        FROM ({METRICS_SQL})
    """,
    "asha_rungs": f"""
        WITH m AS ({METRICS_SQL} HAVING training_iteration IN (1, 4, 16, 64)),
        c AS (SELECT training_iteration, quantile_cont(mean_accuracy, 0.75) AS cut FROM m GROUP BY 1)
        SELECT trial_id, training_iteration::INT AS training_iteration, round(mean_accuracy, 6) AS mean_accuracy,
               round(cut, 6) AS cut, mean_accuracy >= cut AS keep
        FROM m JOIN c USING (training_iteration)
    """,
    "stop_rule": _stop_sql(search.MAX_ITERATIONS),
    "stop_rule_smoke": _stop_sql(search.SMOKE_ITERATIONS),
    "best_trial": _best_sql(
        "SELECT trial_id, max(training_iteration) AS training_iteration,"
        " arg_max(mean_accuracy, training_iteration) AS mean_accuracy FROM m GROUP BY 1"
    ),
    "best_trial_all": _best_sql("SELECT * FROM m"),
    "trial_errors": """
        WITH t AS (SELECT user_id, max(CASE WHEN event_type = 'error' THEN 'failed' END) AS error
                   FROM events GROUP BY 1)
        SELECT count(*) AS trials, count(error) AS errors, count(error) = 0 AS ok FROM t
    """,
}

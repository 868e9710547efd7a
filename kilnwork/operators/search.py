"""Hyper-parameter search: draws, metric reports, stopping, selection, and the trial loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kilnwork.functions import draws
from kilnwork.operators import batches, sampling, training
from kilnwork.operators.models import MAX_BROADCAST_BYTES
from kilnwork.operators.quantiles import quantile_by_group
from kilnwork.session import scratch_path
from kilnwork.sinks import checkpoints

# Fixed values of the search: draw ranges, number of trials, stop criteria.
LR_RANGE = (1e-4, 1e-2)
MOMENTUM_RANGE = (0.1, 0.9)
NUM_TRIALS, SMOKE_TRIALS = 50, 1
TARGET_ACCURACY = 0.98
MAX_ITERATIONS, SMOKE_ITERATIONS = 1000, 5
# Customary settings of successive halving.
GRACE_PERIOD = 1
REDUCTION_FACTOR = 4
HALVING_HORIZON = 100

# The driver holds parameters and velocity of every trial.
MAX_TRIALS = 10_000
# Iterations whose mini-batch samples one scan draws.
SAMPLE_BLOCK = 50
MAX_STATE_BYTES = 4 << 30

METRIC_SCHEMA = pa.schema(
    [
        ("trial_id", pa.int64()),
        ("training_iteration", pa.int32()),
        ("mean_accuracy", pa.float64()),
        ("error", pa.string()),
    ]
)


def draw_params(
    trials: DataFrame,
    key: str = "trial_id",
    lr: tuple[float, float] = LR_RANGE,
    momentum: tuple[float, float] = MOMENTUM_RANGE,
) -> DataFrame:
    """Random-search parameters for each trial id, by hash and so the same on every run."""
    trial = F.col(key)
    return trials.select(
        trial.alias("trial_id"),
        draws.log_uniform(trial, *lr, seed="lr").alias("lr"),
        draws.uniform(trial, *momentum, seed="momentum").alias("momentum"),
    )


def param_space(spark: SparkSession, num_trials: int = NUM_TRIALS) -> DataFrame:
    return draw_params(spark.range(num_trials).withColumnRenamed("id", "trial_id"))


def is_finite(metric: Column) -> Column:
    """Neither NULL nor NaN nor infinite: only such reports are compared, kept or counted as reached."""
    return metric.isNotNull() & ~F.isnan(metric) & (F.abs(metric) != float("inf"))


def report_metrics(outcomes: DataFrame, correct: str, total: str) -> DataFrame:
    """Accuracy per trial and iteration from partial counts of any granularity."""
    return outcomes.groupBy("trial_id", "training_iteration").agg(
        (F.sum(correct) / F.sum(total)).alias("mean_accuracy")
    )


def rung_levels(grace: int = GRACE_PERIOD, reduction: int = REDUCTION_FACTOR, horizon: int = HALVING_HORIZON) -> list[int]:
    """Iterations at which trials are compared: 1, 4, 16, 64 by default."""
    if grace < 1 or reduction < 2:
        raise ValueError("grace must be at least 1 and reduction at least 2")
    levels, level = [], grace
    while level <= horizon:
        levels.append(level)
        level *= reduction
    return levels


def halving_rungs(
    metrics: DataFrame,
    grace: int = GRACE_PERIOD,
    reduction: int = REDUCTION_FACTOR,
    horizon: int = HALVING_HORIZON,
) -> DataFrame:
    """Trials at each rung with the cut they must reach to go on.

    The cut is the ``1 - 1/reduction`` quantile of the rung. There are at most
    a few rungs, so the cuts travel as a literal map. ``metrics`` is read several
    times; where it is not a table already, ``session.materialise`` makes it one.
    """
    levels = rung_levels(grace, reduction, horizon)
    rungs = metrics.filter(F.col("training_iteration").isin(*levels))
    cuts = quantile_by_group(rungs, "training_iteration", "mean_accuracy", 1 - 1 / reduction, levels)
    known = cuts or {0: 0.0}
    table = F.create_map(*[x for level, cut in known.items() for x in (F.lit(level), F.lit(cut))])
    return rungs.withColumn("cut", F.try_element_at(table, F.col("training_iteration").cast("int"))).withColumn(
        "keep", F.coalesce(is_finite(F.col("mean_accuracy")) & (F.col("mean_accuracy") >= F.col("cut")), F.lit(False))
    )


def survivors(metrics: Sequence[tuple[int, float]], reduction: int = REDUCTION_FACTOR) -> set[int]:
    """The same rule for the trials that have just reached a rung."""
    values = [m for _, m in metrics if np.isfinite(m)]
    if not values:
        return set()
    cut = float(np.quantile(values, 1 - 1 / reduction))
    return {trial for trial, m in metrics if np.isfinite(m) and m >= cut}


def until_stopped(
    metrics: DataFrame, target: float = TARGET_ACCURACY, max_iterations: int = MAX_ITERATIONS
) -> DataFrame:
    """Rows of each trial up to the first that meets a stop criterion."""
    reached = is_finite(F.col("mean_accuracy")) & (F.col("mean_accuracy") >= target)
    met = reached | (F.col("training_iteration") >= max_iterations)
    # Grouped with map-side combine, then joined back: a trial with very many rows
    # is neither sorted in one task nor held as a window.
    stops = metrics.groupBy("trial_id").agg(F.min(F.when(met, F.col("training_iteration"))).alias("stop_iteration"))
    ended = F.col("stop_iteration").isNull() | (F.col("training_iteration") <= F.col("stop_iteration"))
    return metrics.join(stops, "trial_id").filter(ended)


def best_trial(metrics: DataFrame, params: DataFrame, scope: str = "last") -> DataFrame:
    """The trial with the highest accuracy, the lowest id on a tie, with its parameters.

    ``scope="last"`` compares the last report of each trial (the highest of repeated ones), ``"all"`` every report.
    Reports that are not finite are left out.
    """
    if scope not in ("last", "all"):
        raise ValueError("scope must be 'last' or 'all'")
    rows = metrics.filter(is_finite(F.col("mean_accuracy")))
    if scope == "last":
        last = F.max(F.struct("training_iteration", "mean_accuracy")).alias("last")
        rows = rows.groupBy("trial_id").agg(last).select("trial_id", "last.*")
    rank = F.struct("mean_accuracy", -F.col("trial_id"), -F.col("training_iteration"))
    best = rows.agg(F.max_by(F.struct("trial_id", "training_iteration", "mean_accuracy"), rank).alias("best"))
    return best.select("best.*").join(params, "trial_id")


def trial_errors(trials: DataFrame) -> DataFrame:
    """Number of trials, number with an error, and whether there is none."""
    errors = F.count_if(F.col("error").isNotNull())
    return trials.agg(F.count(F.lit(1)).alias("trials"), errors.alias("errors"), (errors == 0).alias("ok"))


# Which of the trials ``(trial, metric)`` that have reached a rung, in the order of their ids, go on.
RungRule = Callable[[int, Sequence[tuple[int, float]]], set[int]]


@dataclass
class SearchResult:
    spark: SparkSession
    trials: pa.Table
    reports: list[tuple[int, int, float, str | None]] = field(default_factory=list)
    params: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def metrics(self) -> DataFrame:
        columns = list(zip(*self.reports, strict=True)) or [[]] * len(METRIC_SCHEMA)
        arrays = [pa.array(list(c), kind.type) for c, kind in zip(columns, METRIC_SCHEMA, strict=True)]
        return self.spark.createDataFrame(pa.Table.from_arrays(arrays, schema=METRIC_SCHEMA))

    @property
    def param_table(self) -> DataFrame:
        return self.spark.createDataFrame(self.trials)

    @property
    def best(self) -> DataFrame:
        return best_trial(self.metrics.filter("error is null"), self.param_table)

    def check_errors(self) -> None:
        failed = sorted({r[0] for r in self.reports if r[3]})
        if failed:
            raise RuntimeError(f"trials with errors: {failed}")


def run_search(
    samples: DataFrame,
    trials: DataFrame,
    trainable: training.Trainable,
    *,
    key: str,
    features: str,
    label: str,
    mode: str = "full",
    max_iterations: int = MAX_ITERATIONS,
    target: float = TARGET_ACCURACY,
    grace: int = GRACE_PERIOD,
    reduction: int = REDUCTION_FACTOR,
    horizon: int | None = HALVING_HORIZON,
    batch_size: int = sampling.BATCH_SIZE,
    epoch_cap: int = sampling.EPOCH_CAP,
    test_cap: int = sampling.TEST_CAP,
    checkpoint_path: str | None = None,
    resume: bool = False,
    max_tasks: int | None = None,
    rule: RungRule | None = None,
) -> SearchResult:
    """Train all trials until each is stopped; ``samples`` carry ``is_test``.

    ``mode="full"`` takes one gradient step over all rows in each iteration; one
    distributed pass tests the current parameters and forms the next gradient.
    ``mode="minibatch"`` draws a capped sample for each iteration, the same for
    all trials, and lets each trial train on it in mini-batches in a task of its
    own; the sample is bounded by the caps whatever the table's size.

    Trials end at ``target`` or ``max_iterations``, below the cut at a rung, or
    at ``horizon`` (None turns halving off). Rungs are synchronous unless another
    ``rule`` says which trials go on, such as :func:`~kilnwork.operators.async_halving.arrival_rule`. With
    ``checkpoint_path`` the state is written after every report, and ``resume``
    continues from the last one. ``max_tasks`` is passed on to :func:`training.partial_sums`.
    """
    if mode not in ("full", "minibatch"):
        raise ValueError("mode must be 'full' or 'minibatch'")
    spark = samples.sparkSession
    table = trials.select("trial_id", "lr", "momentum").orderBy("trial_id").limit(MAX_TRIALS + 1).toArrow()
    if len(table) > MAX_TRIALS:
        raise ValueError(f"at most {MAX_TRIALS} trials in one search")
    if 16 * len(table) * trainable.n_params > MAX_STATE_BYTES:
        raise ValueError("the parameters of all trials are too large for the driver")
    result = SearchResult(spark, table)
    ids = table.column("trial_id").to_numpy().astype(np.int64)
    lr, momentum = (table.column(name).to_numpy().astype(float) for name in ("lr", "momentum"))
    params = trainable.initial(ids)
    velocity = np.zeros_like(params)
    live = np.ones(len(ids), dtype=bool)
    iteration = 0
    if resume and checkpoint_path:
        state = checkpoints.latest(spark, checkpoint_path)
        if state is not None:
            iteration = state.iteration
            if sorted(state.trial_ids.tolist()) != sorted(ids.tolist()):
                raise ValueError("the checkpoint holds other trials than the search")
            index = {int(t): i for i, t in enumerate(ids)}
            at = np.array([index[int(t)] for t in state.trial_ids])
            if not np.array_equal(np.stack([state.lr, state.momentum]), np.stack([lr[at], momentum[at]])):
                raise ValueError("the checkpoint's trials have other parameters than the search")
            params[at], velocity[at], live[at] = state.params, state.velocity, state.live
            result.reports = [r for r in state.reports]
    rungs = set(rung_levels(grace, reduction, horizon)) if horizon else set()
    rule = rule or (lambda _, reached: survivors(reached, reduction))
    for level in sorted(level for level in rungs if level <= iteration):  # a rule may remember what it has judged
        rule(level, [(t, np.nan if v is None else v) for t, i, v, _ in result.reports if i == level])
    rows = samples.select(key, features, label, "is_test")
    gradient = None
    ahead: dict[tuple[int, str], DataFrame] = {}
    totals = {False: 0, True: 0}
    if mode == "minibatch":
        totals.update({r["is_test"]: r["count"] for r in rows.groupBy("is_test").count().collect()})

    end = max_iterations if horizon is None else min(max_iterations, horizon)
    while live.any() and iteration < end:
        now = np.flatnonzero(live)
        errors: dict[int, str] = {}
        if mode == "full":
            if gradient is None:
                gradient = _full_pass(rows, trainable, params[now], features, label, max_tasks)[0]
            params[now], velocity[now] = training.momentum_step(
                params[now], velocity[now], gradient, lr[now], momentum[now]
            )
            iteration += 1
            tested = rows.filter("is_test") if iteration >= end else rows
            gradient, accuracy = _full_pass(tested, trainable, params[now], features, label, max_tasks)
        else:
            iteration += 1
            caps = {"train": (epoch_cap, totals[False]), "test": (test_cap, totals[True])}
            if not ahead:
                ahead = _draw_ahead(rows, key, features, label, range(iteration, min(end, iteration + SAMPLE_BLOCK - 1) + 1), caps, batch_size)
            train, test = (
                _gather(ahead[iteration, name], rows, name, key, sampling.rows_within_cap(cap, batch_size), f"{name}-{iteration}", total, features, label)
                for name, (cap, total) in caps.items()
            )
            del ahead[iteration, "train"], ahead[iteration, "test"]
            params[now], velocity[now], accuracy, errors = _minibatch_pass(
                spark, trainable, params[now], velocity[now], lr[now], momentum[now], train, test, batch_size
            )
        going = []
        for slot, (i, value) in enumerate(zip(now, accuracy)):
            error = errors.get(slot)
            if error is None and not (np.isfinite(value) and np.isfinite(params[i]).all()):
                error = "training failed: parameters or accuracy are not finite"
            result.reports.append((int(ids[i]), iteration, float(value) if np.isfinite(value) else None, error))
            if error is None and value < target:
                going.append((int(i), float(value)))
        kept = {i for i, _ in going}
        if iteration in rungs:
            going_on = rule(iteration, [(int(ids[i]), float(v)) for i, v in zip(now, accuracy)])
            kept = {i for i in kept if int(ids[i]) in going_on}
        live[:] = False
        # Trials that only the limit or the horizon ends stay live in the checkpoint, so that a search can
        # be resumed with a higher one.
        live[sorted(kept)] = True
        if gradient is not None:
            gradient = gradient[np.isin(now, sorted(kept))]
        if checkpoint_path:
            now_reported = result.reports[-len(now) :]
            checkpoints.write(spark, checkpoint_path, iteration, ids, lr, momentum, params, velocity, live, now_reported)
    result.params = {int(t): p for t, p in zip(ids, params)}
    return result


def _full_pass(
    rows: DataFrame,
    trainable: training.Trainable,
    params: np.ndarray,
    features: str,
    label: str,
    max_tasks: int | None,
) -> tuple[np.ndarray, np.ndarray]:
    """Mean gradients and test accuracies."""
    sums = training.training_pass(rows, trainable, params, features, label, max_tasks=max_tasks)
    accuracy = sums.correct / sums.test_rows if sums.test_rows else np.full(len(params), np.nan)
    return sums.gradient / max(sums.train_rows, 1), accuracy


def _draw_ahead(
    rows: DataFrame,
    key: str,
    features: str,
    label: str,
    iterations: range,
    caps: dict[str, tuple[int, int]],
    batch_size: int,
) -> dict[tuple[int, str], DataFrame]:
    """Small tables with the samples of several iterations, from one scan of the rows for each of train and test."""
    found = {}
    for name, (cap, total) in caps.items():
        wanted = {f"{name}-{i}": sampling.rows_within_cap(cap, batch_size) for i in iterations}
        part = rows.filter(F.col("is_test") == (name == "test")).select(key, features, label)
        drawn = sampling.samples_of_iterations(part, key, wanted, total)
        path = scratch_path(rows.sparkSession, "samples")
        drawn.write.partitionBy("seed").parquet(path)
        schema = drawn.schema
        for i in iterations:
            found[i, name] = rows.sparkSession.read.schema(schema).parquet(path).filter(F.col("seed") == f"{name}-{i}")
    return found


def _gather(
    drawn: DataFrame, rows: DataFrame, name: str, key: str, n: int, seed: str, total: int, features: str, label: str
) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` rows in hash order as arrays; ``n`` comes from the row caps."""
    if not total:
        raise ValueError("no rows to train or test on")
    table = drawn.orderBy("sample_order", key).limit(n).select(features, label).toArrow()
    if table.num_rows < min(n, total):  # the bound was passed by too few
        part = rows.filter(F.col("is_test") == (name == "test"))
        table = sampling.first_rows(part, key, n, seed).select(features, label).toArrow()
    x, usable = batches.vectors(table.column(0).combine_chunks())
    if not usable.all():
        raise ValueError(f"unusable features in {features}")
    return x, table.column(1).to_numpy().astype(np.int64)


def _minibatch_pass(
    spark: SparkSession,
    trainable: training.Trainable,
    params: np.ndarray,
    velocity: np.ndarray,
    lr: np.ndarray,
    momentum: np.ndarray,
    train: tuple[np.ndarray, np.ndarray],
    test: tuple[np.ndarray, np.ndarray],
    batch_size: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, str]]:
    sample_bytes = sum(part.nbytes for part in (*train, *test))
    # Parameters and velocity of a block of trials, next to the sample.
    block = (MAX_BROADCAST_BYTES - sample_bytes) // (16 * trainable.n_params)
    if block < 1:
        raise ValueError("sample and parameters are too large for one broadcast; use mode='full'")
    parts = []
    for start in range(0, len(params), block):
        rows = slice(start, start + block)
        state = spark.sparkContext.broadcast((params[rows], velocity[rows], lr[rows], momentum[rows], train, test))
        parts.append(_train_block(spark, trainable, state, len(params[rows]), batch_size))
        state.destroy()
    done = pa.concat_tables(parts)
    errors = {i: e for i, e in enumerate(done.column("error").to_pylist()) if e is not None}
    w, v = (done.column(n).combine_chunks().flatten().to_numpy().reshape(len(done), -1) for n in ("w", "v"))
    return w, v, done.column("accuracy").to_numpy(), errors


def _train_block(
    spark: SparkSession, trainable: training.Trainable, state: Broadcast, trials: int, batch_size: int
) -> pa.Table:
    """``slot, w, v, accuracy, error`` of each trial of a block in their order, trained in parallel tasks."""
    slots = spark.range(trials, numPartitions=min(trials, 4 * spark.sparkContext.defaultParallelism))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, velocity, rates, momenta, (x, y), (test_x, test_y) = state.value
        for batch in stream:
            for slot in batch.column("id").to_pylist():
                w, v, accuracy, error = params[slot], velocity[slot], float("nan"), None
                try:
                    w, v = training.minibatch_epoch(trainable, w, v, x, y, rates[slot], momenta[slot], batch_size)
                    accuracy = float(trainable.correct(w[None], test_x, test_y)[0]) / len(test_x)
                except Exception as e:  # a failing trial must not end the others
                    error = f"{type(e).__name__}: {e}"
                done = {"slot": [slot], "w": [w], "v": [v], "accuracy": [accuracy], "error": pa.array([error], pa.string())}
                yield pa.RecordBatch.from_pydict(done)

    schema = "slot long, w array<double>, v array<double>, accuracy double, error string"
    return slots.mapInArrow(run, schema).toArrow().sort_by("slot")

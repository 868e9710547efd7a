"""Search state as Parquet, one folder for each iteration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_STATE = (
    "trial_id long, lr double, momentum double, params array<double>, velocity array<double>, live boolean, "
    "reported boolean, mean_accuracy double, error string"
)


@dataclass(frozen=True)
class SearchState:
    iteration: int
    trial_ids: np.ndarray
    lr: np.ndarray
    momentum: np.ndarray
    params: np.ndarray
    velocity: np.ndarray
    live: np.ndarray
    reports: list[tuple[int, int, float, str | None]]


def write(
    spark: SparkSession,
    path: str,
    iteration: int,
    trial_ids: np.ndarray,
    lr: np.ndarray,
    momentum: np.ndarray,
    params: np.ndarray,
    velocity: np.ndarray,
    live: np.ndarray,
    reports: list[tuple[int, int, float, str | None]],
) -> None:
    """Write the state after ``iteration`` and its reports, one row for each trial.

    Each iteration has a folder that is overwritten as a whole, so a repeated
    write after a failure leaves no duplicates.
    """
    fresh = {r[0]: r for r in reports if r[1] == iteration}
    found = [fresh.get(int(t)) for t in trial_ids]
    state = pa.table(
        {
            "trial_id": pa.array(trial_ids, pa.int64()),
            "lr": pa.array(lr, pa.float64()),
            "momentum": pa.array(momentum, pa.float64()),
            "params": _rows(params),
            "velocity": _rows(velocity),
            "live": pa.array(np.asarray(live, bool)),
            "reported": pa.array([r is not None for r in found]),
            "mean_accuracy": pa.array([r[2] if r else None for r in found], pa.float64()),
            "error": pa.array([r[3] if r else None for r in found], pa.string()),
        }
    )
    table = spark.createDataFrame(state).coalesce(1)
    table.write.mode("overwrite").parquet(f"{path}/training_iteration={iteration}")


def _rows(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix, np.float64)
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{_STATE}, training_iteration int").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``trial_id, training_iteration, param_index, value, velocity, live`` of all iterations."""
    cells = _states(spark, path).select(
        "trial_id", "training_iteration", "live", F.posexplode(F.arrays_zip("params", "velocity"))
    )
    return cells.select(
        "trial_id",
        "training_iteration",
        F.col("pos").alias("param_index"),
        F.col("col.params").alias("value"),
        "col.velocity",
        "live",
    )


def latest(spark: SparkSession, path: str) -> SearchState | None:
    """The last state, or None where there is none yet."""
    try:
        states = _states(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    iteration = states.agg(F.max("training_iteration")).first()[0]
    if iteration is None:
        return None
    rows = states.filter(F.col("training_iteration") == iteration).orderBy("trial_id").toArrow()
    reports = states.filter("reported").orderBy("training_iteration", "trial_id")
    return SearchState(
        int(iteration),
        rows.column("trial_id").to_numpy(),
        rows.column("lr").to_numpy(),
        rows.column("momentum").to_numpy(),
        _matrix(rows.column("params")),
        _matrix(rows.column("velocity")),
        rows.column("live").to_numpy().astype(bool),
        [tuple(r) for r in reports.select("trial_id", "training_iteration", "mean_accuracy", "error").collect()],
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1).copy()

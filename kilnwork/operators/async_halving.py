"""Successive halving that judges reports as they come.

A trial that reaches a rung is compared with the reports of that rung so far, and waits for no other. What is kept of a
search is small: for each rung its values in order, for each trial how far it has come and whether it goes on.
"""

from __future__ import annotations

import bisect
import heapq
import json
import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from kilnwork.operators import search

JUDGED_COLUMNS = ("trial_id", "training_iteration", "mean_accuracy", "cut", "keep")


@dataclass
class Rungs:
    """The state of one search: values reached at each rung, in order, and the trials that were stopped."""

    grace: int = search.GRACE_PERIOD
    reduction: int = search.REDUCTION_FACTOR
    horizon: int = search.HALVING_HORIZON
    values: dict[int, list[float]] = field(default_factory=dict)
    stopped: set[int] = field(default_factory=set)

    @property
    def levels(self) -> list[int]:
        return search.rung_levels(self.grace, self.reduction, self.horizon)

    def cut(self, level: int) -> float | None:
        """The ``1 - 1/reduction`` quantile of what has reached the rung so far; None before the first."""
        seen = self.values.get(level)
        if not seen:
            return None
        place = (len(seen) - 1) * (1 - 1 / self.reduction)
        low = math.floor(place)
        high = min(low + 1, len(seen) - 1)
        return seen[low] + (seen[high] - seen[low]) * (place - low)

    def judge(self, trial: int, level: int, metric: float | None) -> tuple[float | None, bool] | None:
        """The cut that the trial met and whether it goes on; None if it was stopped before.

        A value that is missing or not finite stops the trial and is not compared with later ones.
        """
        if trial in self.stopped:
            return None
        cut = self.cut(level)
        fine = metric is not None and math.isfinite(metric)
        keep = fine and (cut is None or metric >= cut)
        if fine:
            bisect.insort(self.values.setdefault(level, []), metric)
        if not keep:
            self.stopped.add(trial)
        return cut, keep

    def merged(self, other: Rungs) -> Rungs:
        """The state of a search that two schedulers share: later reports are judged against the values of both."""
        values = {level: list(heapq.merge(self.values.get(level, []), other.values.get(level, []))) for level in {*self.values, *other.values}}
        return Rungs(self.grace, self.reduction, self.horizon, values, self.stopped | other.stopped)

    def to_json(self) -> str:
        return json.dumps({"values": {str(k): v for k, v in self.values.items()}, "stopped": sorted(self.stopped)})

    @classmethod
    def from_json(cls, text: str, **settings: int) -> Rungs:
        held = json.loads(text)
        return cls(**settings, values={int(k): v for k, v in held["values"].items()}, stopped=set(held["stopped"]))


def judged(rungs: Rungs, reports: Iterable[tuple[int, int, float | None]]) -> Iterator[tuple]:
    """``JUDGED_COLUMNS`` of each report ``(trial, iteration, metric)`` that is judged, in the given order."""
    for trial, iteration, metric in reports:
        verdict = rungs.judge(trial, iteration, metric)
        if verdict is not None:
            yield trial, iteration, metric, *verdict


def arrival_rule(
    grace: int = search.GRACE_PERIOD, reduction: int = search.REDUCTION_FACTOR, horizon: int = search.HALVING_HORIZON
) -> search.RungRule:
    """A rule for :func:`~kilnwork.operators.search.run_search`: trials that report together are judged one after the other.

    None waits for the others: the first goes on, and each later one is compared with those before it. For one search.
    """
    rungs = Rungs(grace, reduction, horizon)

    def rule(level: int, reached: Sequence[tuple[int, float]]) -> set[int]:
        return {trial for trial, _, _, _, keep in judged(rungs, ((t, level, m) for t, m in sorted(reached))) if keep}

    return rule


def judged_schema(reports: DataFrame, key: str) -> StructType:
    rest = StructType.fromDDL("trial_id long, training_iteration int, mean_accuracy double, cut double, keep boolean")
    return StructType([reports.schema[key], *rest.fields])


def halving_async(
    reports: DataFrame,
    key: str = "search_id",
    order: tuple[str, ...] = ("ts", "seq"),
    trial: str = "trial_id",
    metric: str = "mean_accuracy",
    grace: int = search.GRACE_PERIOD,
    reduction: int = search.REDUCTION_FACTOR,
    horizon: int = search.HALVING_HORIZON,
) -> DataFrame:
    """Reports at a rung with the cut they met and whether their trial goes on, judged by ``order`` within each search.

    The n-th report of a trial is its iteration n. Only the first reports of a trial, up to the last rung, are moved to
    its search, so that a trial or search with most of the rows is no larger than others: the group of a search holds a row
    for each trial and rung. Reports of a trial after it was stopped are left out. Reports that are equal in ``order`` go
    by trial and value.
    """
    levels = search.rung_levels(grace, reduction, horizon)
    place = [F.col(c).asc_nulls_first() for c in order]
    rows = reports.select(key, F.col(trial).cast("long").alias("trial_id"), F.col(metric).cast("double").alias("mean_accuracy"), *order)
    nth = F.row_number().over(Window.partitionBy(key, "trial_id").orderBy(*place, "mean_accuracy"))
    # The bound on the rank lets each task drop later reports before they are moved.
    first = rows.withColumn("training_iteration", nth).filter(F.col("training_iteration") <= levels[-1])
    at_rung = first.filter(F.col("training_iteration").isin(*levels))
    schema, most = judged_schema(reports, key), search.MAX_TRIALS

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([*((c, "ascending") for c in order), ("trial_id", "ascending"), ("training_iteration", "ascending")])
        if len(set(table.column("trial_id").to_pylist())) > most:
            raise ValueError(f"at most {most} trials in one search")
        rows = zip(*(table.column(c).to_pylist() for c in ("trial_id", "training_iteration", "mean_accuracy")), strict=True)
        done = list(zip(*judged(Rungs(grace, reduction, horizon), rows), strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.bool_())
        keys = pa.array([table.column(key)[0].as_py()] * len(done[0]), table.schema.field(key).type)
        return pa.Table.from_arrays([keys, *(pa.array(list(c), k) for c, k in zip(done, kinds, strict=True))], names=schema.names)

    return at_rung.groupBy(key).applyInArrow(run, schema)

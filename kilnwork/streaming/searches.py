"""Searches scheduled from a stream of reports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kilnwork.operators import search
from kilnwork.operators.async_halving import JUDGED_COLUMNS, Rungs, judged, judged_schema


class RungScheduler(StatefulProcessor):
    """Keeps the rungs of one search, and for each trial the number of its reports.

    Of a trial with many reports in a batch only the first up to the last rung are held at a time.
    """

    def __init__(self, key: str, order: tuple[str, ...], settings: dict[str, int]):
        self._key, self._order, self._settings = key, list(order), settings
        self._levels = Rungs(**settings).levels

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._rungs = handle.getValueState("rungs", "state string")
        self._seen = handle.getMapState("seen", "trial_id long", "reports int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, held, arrived = self._levels[-1], None, {}
        by = [*self._order, "trial_id", "mean_accuracy"]
        for part in rows:
            for trial, n in part["trial_id"].value_counts().items():
                arrived[int(trial)] = arrived.get(int(trial), 0) + int(n)
            part = part[["trial_id", "mean_accuracy", *self._order]]
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            held = held.sort_values(by, kind="stable", na_position="first").groupby("trial_id", sort=False).head(last)
        if held is None:
            return
        before = {t: self._seen.getValue((t,))[0] if self._seen.containsKey((t,)) else 0 for t in arrived}
        if len(before) > search.MAX_TRIALS:
            raise ValueError(f"at most {search.MAX_TRIALS} trials in one search")
        held["training_iteration"] = held.groupby("trial_id", sort=False).cumcount() + 1 + held["trial_id"].map(before)
        held = held[held["training_iteration"].isin(self._levels)]
        state = self._rungs.get()
        rungs = Rungs.from_json(state[0], **self._settings) if state else Rungs(**self._settings)
        metrics = [None if pd.isna(m) else float(m) for m in held["mean_accuracy"]]
        done = list(judged(rungs, zip(held["trial_id"].astype(int), held["training_iteration"].astype(int), metrics, strict=True)))
        for trial, n in arrived.items():  # beyond the last rung the number no longer matters
            self._seen.updateValue((trial,), (min(before[trial] + n, last + 1),))
        self._rungs.update((rungs.to_json(),))
        if done:
            out = pd.DataFrame(done, columns=list(JUDGED_COLUMNS)).astype({"training_iteration": "int32", "mean_accuracy": float, "cut": float})
            out.insert(0, self._key, key[0])
            yield out

    def close(self) -> None:
        pass


def schedule_async(
    reports: DataFrame,
    key: str = "search_id",
    order: tuple[str, ...] = ("ts", "seq"),
    trial: str = "trial_id",
    metric: str = "mean_accuracy",
    **settings: int,
) -> DataFrame:
    """The streaming form of :func:`~kilnwork.operators.async_halving.halving_async`: verdicts as reports arrive.

    Reports of one micro-batch go by ``order``, micro-batches by their arrival. ``settings`` are those of the rungs.
    Needs the RocksDB state store.
    """
    rows = reports.selectExpr(key, f"cast({trial} as long) AS trial_id", f"cast({metric} as double) AS mean_accuracy", *order)
    return rows.groupBy(key).transformWithStateInPandas(
        RungScheduler(key, tuple(order), settings), judged_schema(rows, key), "append", "none"
    )

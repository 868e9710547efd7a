"""Following jobs until they end or stop reporting."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kilnwork.functions import status as states

TIMED_OUT = "TIMED_OUT"

ENDED = "job_id long, outcome string, ended_at timestamp, last_status string"


class JobPoller(StatefulProcessor):
    """Waits for the end of one job: a terminal status, or ``patience_ms`` without a report.

    The state is the job's last report. A timer of event time ends the wait where no later report comes at all; a report
    that comes too late finds the wait over. After its end a job is not followed any more.
    """

    def __init__(self, patience_ms: int, terminal: tuple[str, ...]):
        self._patience, self._terminal = patience_ms, terminal

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at long, status string, over boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Times and statuses only, in order; the reports themselves are not held.
        parts = [(p["ts"].to_numpy("datetime64[ms]").astype(np.int64), p["seq"].to_numpy(np.int64), p["status"].astype(object).to_numpy()) for p in rows]
        times, seqs, names = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((seqs, times))
        times, names = times[order], names[order]
        state = self._last.get()
        if state and state[2]:
            return
        before = state[0] if state else None
        end = None
        if before is not None:
            later = times >= before
            times, names = times[later], names[later]
            previous = np.concatenate([[before], times[:-1]]) if len(times) else times
        else:
            previous = np.concatenate([times[:1], times[:-1]])
        ends = np.isin(names, self._terminal)
        silent = times - previous > self._patience
        at = np.flatnonzero(ends | silent)
        if len(at):
            i = int(at[0])
            if silent[i]:
                last = names[i - 1] if i else state[1]
                end = (TIMED_OUT, int(previous[i]) + self._patience, last)
            else:
                end = (names[i], int(times[i]), names[i])
        if before is not None:
            self._handle.deleteTimer(before + self._patience)
        if end:
            self._last.update((end[1], end[2], True))
            yield self._row(key, *end)
        elif len(times) or before is not None:
            last = (int(times[-1]), names[-1]) if len(times) else (before, state[1])
            self._last.update((*last, False))
            self._handle.registerTimer(last[0] + self._patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, status, over = self._last.get()
        if not over and expiredTimerInfo.getExpiryTimeInMs() == at + self._patience:
            self._last.update((at, status, True))
            yield self._row(key, TIMED_OUT, at + self._patience, status)

    @staticmethod
    def _row(key, outcome: str, at: int, status: str | None) -> pd.DataFrame:
        return pd.DataFrame({"job_id": [key[0]], "outcome": [outcome], "ended_at": [pd.Timestamp(at, unit="ms")], "last_status": [status]})

    def close(self) -> None:
        pass


def job_endings(events: DataFrame, patience: dt.timedelta, watermark: str) -> DataFrame:
    """``job_id, outcome, ended_at, last_status`` of each job that has ended, from a stream of job events.

    ``outcome`` is the first terminal status, or ``TIMED_OUT`` once ``patience`` has passed without a report; a time-out
    ends ``patience`` after the last report before it. Events without a job or time are left out. Within a micro-batch
    events go by ``ts`` and ``seq``; one that is older than what its job reported in an earlier batch is left out too.
    Times count in milliseconds. Needs the RocksDB state store.
    """
    rows = events.filter("job_id is not null and ts is not null").withWatermark("ts", watermark)
    keyed = rows.select(F.col("job_id").cast("long").alias("job_id"), "seq", "ts", "status").groupBy("job_id")
    poller = JobPoller(round(patience.total_seconds() * 1000), tuple(states.TERMINAL_STATES))
    return keyed.transformWithStateInPandas(poller, ENDED, "append", "EventTime")

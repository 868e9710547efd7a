"""Exact quantiles of large groups without gathering a group in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# A group with this many rows or fewer left is sorted in one task.
SORT_LIMIT = 100_000
_BUCKETS = 1024
_MAX_GROUPS = 10_000


@dataclass
class _Search:
    """Values of ranks ``rank`` and ``rank + 1`` (from 0) lie in [low, high], ``rows`` rows in all."""

    low: float
    high: float
    rank: int
    rows: int
    fraction: float

    def value(self, first: float, second: float) -> float:
        if not self.fraction or first == second:
            return first
        return first + (second - first) * self.fraction


def quantile_by_group(
    df: DataFrame,
    group: str,
    value: str,
    q: float,
    groups: Sequence[int],
    sort_limit: int = SORT_LIMIT,
) -> dict[int, float]:
    """Linear-interpolated quantile ``q`` of ``value`` in each of a short list of ``groups``.

    Counting the values in equal-width buckets tells which bucket holds the
    wanted rank; counting again inside that bucket narrows it further, until
    the rest is small enough to sort. Every pass is a grouped count with
    map-side combine whose result has at most 1,024 rows per group, so a group
    with a third of all rows costs no more than the others. NULL and NaN are left out.
    """
    if len(groups) > _MAX_GROUPS:
        raise ValueError(f"at most {_MAX_GROUPS} groups; quantiles come back to the driver")
    rows = df.select(F.col(group).cast("long").alias("g"), F.col(value).cast("double").alias("v")).filter(
        F.col("g").isin(*groups) & F.col("v").isNotNull() & ~F.isnan("v")
    )
    done: dict[int, float] = {}
    active: dict[int, _Search] = {}
    for r in rows.groupBy("g").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        position = q * (r["n"] - 1)
        rank = min(math.floor(position), max(r["n"] - 2, 0))
        active[r["g"]] = _Search(r["lo"], r["hi"], rank, r["n"], position - rank)

    while active:
        for g, s in list(active.items()):
            if s.low == s.high:
                done[g] = active.pop(g).low
        small = {g: s for g, s in active.items() if s.rows <= sort_limit}
        if small:
            inside = _inside(rows, small).groupBy("g").agg(F.sort_array(F.collect_list("v")).alias("vs"))
            start = _lookup({g: s.rank + 1 for g, s in small.items()})
            for r in inside.select("g", F.slice("vs", start, 2).alias("pair")).collect():
                pair = r["pair"]
                done[r["g"]] = active.pop(r["g"]).value(pair[0], pair[-1])
        if active:
            _narrow(rows, active, done)
    return done


def _lookup(values: dict[int, float | int]) -> Column:
    """A literal map indexed by the group."""
    pairs = [x for g, v in values.items() for x in (F.lit(g).cast("long"), F.lit(v))]
    return F.create_map(*pairs)[F.col("g")]


def _inside(rows: DataFrame, searches: dict[int, _Search]) -> DataFrame:
    """Rows of the searched groups that lie in their bracket, with its ends."""
    return (
        rows.filter(F.col("g").isin(*searches))
        .withColumn("lo", _lookup({g: s.low for g, s in searches.items()}))
        .withColumn("hi", _lookup({g: s.high for g, s in searches.items()}))
        .filter("v between lo and hi")
    )


def _narrow(rows: DataFrame, active: dict[int, _Search], done: dict[int, float]) -> None:
    """Shrink each bracket to the bucket of its rank, or finish where two buckets hold the two ranks."""
    # Halves don't overflow. Infinite ends have buckets of their own, so the next pass lies between finite ends.
    # Subtraction, division and multiplication are monotone, so buckets keep the order of the
    # values; the lowest and the highest value never share one, so every pass gets closer.
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    halves = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    share = F.when(hi - lo == math.inf, halves).otherwise((v - lo) / (hi - lo))
    finite = F.when(F.col("v") == -math.inf, -1.0).when(F.col("v") == math.inf, float(_BUCKETS))
    wide = F.abs(F.col("lo")) == math.inf, F.abs(F.col("hi")) == math.inf
    # With an infinite end the finite values are told apart by sign and binary exponent for this pass.
    size = F.signum("v") * (F.log2(F.abs("v")) + 1080)
    rough = F.floor(F.coalesce((F.when(F.col("v") == 0, 0.0).otherwise(size) / 2200 + 1) / 2, F.lit(0.5)) * (_BUCKETS - 1))
    bucket = finite.when(wide[0] | wide[1], rough.cast("double")).otherwise(F.floor(share * (_BUCKETS - 1)).cast("double"))
    counts = (
        _inside(rows, active)
        .groupBy("g", bucket.alias("bucket"))
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy("g", "bucket")
        .collect()
    )
    below = dict.fromkeys(active, 0)
    first: dict[int, float] = {}
    open_groups = dict(active)
    for r in counts:
        g, start = r["g"], below[r["g"]]
        below[g] = end = start + r["n"]
        if g not in open_groups or open_groups[g].rank >= end:
            continue
        s = open_groups[g]
        if g in first:  # rank + 1 is the smallest value of the next bucket
            done[g] = active.pop(g).value(first[g], r["lo"])
        elif s.rank + 1 < end:
            active[g] = _Search(r["lo"], r["hi"], s.rank - start, r["n"], s.fraction)
        else:
            first[g] = r["hi"]
            continue
        del open_groups[g]

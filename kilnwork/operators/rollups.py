"""Counts, states and labels over job and metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kilnwork.functions import status as states

SCRAPE_INTERVAL = "15 seconds"


def stage_counts(loaded: DataFrame, is_image: Column, predictions: DataFrame) -> DataFrame:
    """Rows loaded, images among them, and predictions that the scorer gave: rows of its output or of what was written."""
    read = loaded.agg(F.count(F.lit(1)).alias("loaded"), F.count_if(is_image).alias("images"))
    made = predictions.agg(F.count(F.lit(1)).alias("predictions"))
    both = read.unionByName(made, allowMissingColumns=True)
    return both.agg(*(F.sum(name).alias(name) for name in ("loaded", "images", "predictions")))


def ready_total(df: DataFrame, key: str, ready: Column) -> DataFrame:
    """Rows in the wanted state and rows in all, per key."""
    return df.groupBy(key).agg(F.count_if(ready).alias("ready"), F.count(F.lit(1)).alias("total"))


def latest_status(events: DataFrame) -> DataFrame:
    """The last status of each job by ``ts``, then ``seq``."""
    last = F.max_by(F.struct("status", "ts"), F.struct("ts", "seq"))
    return events.groupBy("job_id").agg(last.alias("last")).select("job_id", "last.status", "last.ts")


def with_outcome(jobs: DataFrame) -> DataFrame:
    return jobs.withColumns(
        {"terminal": states.is_terminal(F.col("status")), "outcome": states.outcome(F.col("status"))}
    )


def union_metrics(parts: dict[str, DataFrame]) -> DataFrame:
    """Metric tables of several scrape jobs as one, with the job's name."""
    named = [df.withColumn("job", F.lit(job)) for job, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), named)


def attach_labels(
    samples: DataFrame, static: dict[str, str], per_target: DataFrame | None = None, target: str = "metric"
) -> DataFrame:
    """Add labels that hold for all samples, and labels of the sample's target.

    ``per_target`` has the target and a ``target_labels`` map. The join carries no
    hint: Spark broadcasts the table if its size allows. Labels of the sample
    win over those of the target, and those over the static ones.
    """
    common = F.create_map(*[x for pair in static.items() for x in map(F.lit, pair)]) if static else _no_labels()
    if per_target is None:
        return samples.withColumn("labels", _merge(F.col("labels"), common))
    # Static labels join those of the target once for each target, not for each sample.
    targets = per_target.select(target, _merge(F.col("target_labels"), common).alias("target_labels"))
    joined = samples.join(targets, target, "left")
    merged = _merge(F.col("labels"), F.coalesce("target_labels", common))
    return joined.withColumn("labels", merged).drop("target_labels")


def _no_labels() -> Column:
    return F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")


def _merge(winner: Column, other: Column) -> Column:
    """Both maps in one, where ``winner`` keeps its value of a shared name."""
    shared = F.arrays_overlap(F.map_keys(winner), F.map_keys(other))
    rest = F.map_filter(other, lambda name, _: ~F.map_contains_key(winner, name))
    # Shared names are rare, and the filter is interpreted; the plain concatenation is not.
    return F.when(shared, F.map_concat(winner, rest)).otherwise(F.map_concat(winner, other))


def tumbling(samples: DataFrame, every: str = SCRAPE_INTERVAL) -> DataFrame:
    """Count, sum and extremes of each metric in fixed windows; batch or streaming."""
    return samples.groupBy(F.window("ts", every), "metric").agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum("value").alias("sum_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def target_up(samples: DataFrame, target: str) -> DataFrame:
    """``UP`` or ``DOWN`` by the last sample of each target; 0 is down. Of samples at one instant the highest counts."""
    last = F.max(F.struct("ts", "value"))["value"]
    return samples.groupBy(target).agg(
        F.when(last == 0, "DOWN").otherwise("UP").alias("state"), F.max("ts").alias("last_seen")
    )


def target_up_grid(samples: DataFrame, target: str, every: str = SCRAPE_INTERVAL, stale: str | None = None) -> DataFrame:
    """``target, tick, state, last_seen`` at every tick from the first to the last sample of any target.

    A target is ``DOWN`` where its last sample is 0 or older than ``stale`` (one interval unless given), or where it has none.
    A sample goes to the few ticks at which it is not yet stale; of those of a tick the last counts, which needs no order
    and is found before rows are moved. So a target with most of the samples is no harder than others. ``last_seen`` is
    NULL where no sample is fresh.
    """
    micros = lambda text: F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp") + F.expr(f"interval {text}")) - F.unix_micros(F.lit("1970-01-01 00:00:00").cast("timestamp"))
    step, life = micros(every), micros(stale or every)
    rows = samples.select(target, F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "value").filter("at is not null")
    first, last = F.ceil(F.col("at") / step).cast("long") * step, F.floor((F.col("at") + life) / step).cast("long") * step
    fresh = rows.filter(last >= first).select(target, F.explode(F.sequence(first, last, step)).alias("tick"), "at", "value")
    known = fresh.groupBy(target, "tick").agg(F.max(F.struct("at", "value")).alias("last"))
    since, until = rows.agg(F.min(first), F.max(first)).first()
    grid = F.sequence(F.lit(since), F.lit(until), step) if since is not None else F.array().cast("array<bigint>")
    ticks = rows.select(target).distinct().select(target, F.explode(grid).alias("tick"))
    joined = ticks.join(known, (ticks[target].eqNullSafe(known[target])) & (ticks["tick"] == known["tick"]), "left")
    up = F.coalesce(F.col("last.value") != 0, F.lit(False))
    return joined.select(
        ticks[target],
        F.timestamp_micros(ticks["tick"]).alias("tick"),
        F.when(up, "UP").otherwise("DOWN").alias("state"),
        F.timestamp_micros("last.at").alias("last_seen"),
    )

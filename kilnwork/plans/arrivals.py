"""Reports, scrapes, logs and jobs as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.functions import exposition
from kilnwork.operators import async_halving, logs, rollups, search
from kilnwork.plans.inputs import STATUS_OF_EVENT, STATUS_SQL, table
from kilnwork.plans.metrics import _TS, _event_stream
from kilnwork.session import scratch_path
from kilnwork.sources import scrapes, tables
from kilnwork.streaming import endings, polls, searches, streams

# Targets that the events are scraped from, and the grid and patience of the queries.
_TARGETS = 16
_GRID = "1 hour"
_PATIENCE = dt.timedelta(hours=12)


def _reports(events: DataFrame) -> DataFrame:
    """Every event as a report of its user's trial; fifty users search together. Cents are points of 10,000."""
    points = F.least(F.round(F.col("value") * 100), F.lit(10_000.0))
    return events.select(
        F.floor(F.col("user_id") / search.NUM_TRIALS).cast("long").alias("search_id"),
        F.col("user_id").alias("trial_id"),
        "ts",
        F.col("event_id").alias("seq"),
        points.alias("mean_accuracy"),
    )


def _verdicts(judged: DataFrame) -> DataFrame:
    part = lambda name: F.round(F.col(name) / 10_000, 6).alias(name)
    return judged.select("search_id", "trial_id", "training_iteration", part("mean_accuracy"), part("cut"), "keep")


def asha_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(async_halving.halving_async(_reports(table(spark, sf_dir, "events"))))


def stream_asha_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "verdicts")
    judged = searches.schedule_async(_reports(_event_stream(spark, sf_dir)))
    streams.run_to_table(judged, out, scratch_path(spark, "verdicts-state"), rocksdb=True).awaitTermination()
    return _verdicts(spark.read.schema(judged.schema).parquet(out))


def _exposed(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the events as scraped text: of each target its metrics' types and their samples."""
    path = scratch_path(spark, "scrapes")
    target = F.concat(F.lit("node-"), (F.col("user_id") % _TARGETS).cast("string")).alias("target")
    labels = F.map_from_arrays(F.array(F.lit("user"), F.lit("props")), F.array(F.col("user_id").cast("string"), F.col("props")))
    events = table(spark, sf_dir, "events")
    instant = streams.as_instant(F.col("ts"))
    samples = events.select(target, exposition.exposed(F.col("event_type"), labels, F.col("value"), instant).alias("line"))
    types = events.select(target, F.concat(F.lit("# TYPE "), "event_type", F.lit(" gauge")).alias("line")).distinct()
    samples.unionByName(types).write.partitionBy("target").text(path)
    return path


def _scraped(samples: DataFrame) -> DataFrame:
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("ts").cast("timestamp_ntz"))
    return samples.select(
        "target",
        "metric",
        F.col("labels")["user"].alias("label_user"),
        F.col("labels")["props"].alias("label_props"),
        "value",
        utc.cast("string").alias("ts"),
        "error",
    )


def scrape_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scraped(scrapes.parsed_lines(scrapes.scrape_folder(spark, _exposed(spark, sf_dir))))


def stream_scrape_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "samples")
    parsed = scrapes.parsed_lines(scrapes.scrape_folder(spark, _exposed(spark, sf_dir), stream=True))
    streams.run_to_table(parsed, out, scratch_path(spark, "samples-state")).awaitTermination()
    return _scraped(spark.read.schema(parsed.schema).parquet(out))


def scrape_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scrapes.described(scrapes.scrape_folder(spark, _exposed(spark, sf_dir)))


def log_tail_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as the parts of their conversation's log."""
    parts = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("text", F.lit("\n")).alias("text"))
    return logs.tail_of_parts(parts, "conv_id", "turn", "text")


def target_up_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "user_id", streams.as_instant(F.col("ts")).alias("ts"), F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value")
    )
    utc = lambda name: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(name).cast("timestamp_ntz")).cast("string").alias(name)
    return rollups.target_up_grid(rows, "user_id", _GRID).select("user_id", utc("tick"), "state", utc("last_seen"))


def job_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that have ended by the last event, by their status or by half a day without a report."""
    out, state, ends = (scratch_path(spark, name) for name in ("endings", "endings-state", "ends"))
    events = tables.job_events(
        _event_stream(spark, sf_dir),
        job_id=F.col("user_id"),
        seq=F.col("event_id"),
        ts=streams.as_instant(F.col("ts")),
        status=tables.mapped(F.col("event_type"), STATUS_OF_EVENT),
        log=F.lit(None).cast("string"),
    )

    def start():
        arriving = endings.with_endings(events, ends)
        return streams.run_to_table(polls.job_endings(arriving, _PATIENCE, streams.WATERMARK), out, state, rocksdb=True)

    def last_event():
        newest = table(spark, sf_dir, "events").agg(F.max(streams.as_instant(F.col("ts"))).alias("ts"))
        held = newest.select((F.col("ts") + F.expr(f"interval {streams.WATERMARK}")).cast("timestamp").alias("ts")).select(F.unix_micros("ts")).first()[0]
        return None if held is None else dt.datetime.fromtimestamp(held // 1000 / 1000 + 0.001, dt.timezone.utc)

    endings.run_to_end(start, spark, ends, last_event)
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("ended_at").cast("timestamp_ntz")).cast("string")
    return spark.read.schema(polls.ENDED).parquet(out).select("job_id", "outcome", utc.alias("ended_at"), "last_status")


QUERIES = {
    "asha_async": asha_async,
    "stream_asha_async": stream_asha_async,
    "scrape_parse": scrape_parse,
    "stream_scrape_parse": stream_scrape_parse,
    "scrape_described": scrape_described,
    "log_tail_parts": log_tail_parts,
    "target_up_grid": target_up_grid,
    "job_timeouts": job_timeouts,
}


def _async_sql() -> str:
    """One rung after the other: those who went on from the one before, each against the values before its own."""
    parts = ["""
        WITH r AS (SELECT user_id // 50 AS search_id, user_id AS trial_id, ts, event_id, least(round(value * 100), 10000)::DOUBLE AS points,
                          row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""]
    levels, before = search.rung_levels(), ""
    for level in levels:
        parts.append(f"""
        j{level} AS (
            SELECT *, cut IS NULL OR points >= cut AS keep FROM (
                SELECT r.*, quantile_cont(points, 0.75) OVER (PARTITION BY search_id ORDER BY ts, event_id
                                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cut
                FROM r {before} WHERE n = {level}))""")
        before = f"JOIN (SELECT trial_id FROM j{level} WHERE keep) USING (trial_id)"
    chosen = """ SELECT search_id, trial_id, n::INT AS training_iteration, round(points / 10000, 6) AS mean_accuracy,
                        round(cut / 10000, 6) AS cut, keep FROM j{0}"""
    return ",".join(parts) + " UNION ALL ".join(chosen.format(level) for level in levels)


_SCRAPED = f"""
    SELECT 'node-' || user_id % {_TARGETS} AS target, event_type AS metric, user_id::VARCHAR AS label_user, props AS label_props, value,
           {_TS.format('t')} AS ts, NULL AS error
    FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM events)
"""

ORACLES = {
    "asha_async": _async_sql(),
    "stream_asha_async": _async_sql(),
    "scrape_parse": _SCRAPED,
    "stream_scrape_parse": _SCRAPED,
    "scrape_described": "SELECT DISTINCT event_type AS metric, 'gauge' AS type, NULL AS help FROM events",
    "log_tail_parts": """
        SELECT conv_id, right(string_agg(text || chr(10), '' ORDER BY turn), 1024) AS tail FROM conversations GROUP BY 1
    """,
    "target_up_grid": f"""
        WITH s AS (SELECT user_id, ts, max((event_type <> 'error')::INT) AS value FROM events GROUP BY 1, 2),
        g AS (SELECT user_id, unnest(range(since, until + INTERVAL {_GRID}, INTERVAL {_GRID})) AS tick
              FROM (SELECT DISTINCT user_id FROM events),
                   (SELECT time_bucket(INTERVAL {_GRID}, min(ts) + INTERVAL {_GRID} - INTERVAL 1 MICROSECOND) AS since,
                           time_bucket(INTERVAL {_GRID}, max(ts) + INTERVAL {_GRID} - INTERVAL 1 MICROSECOND) AS until FROM events))
        SELECT user_id, {_TS.format('tick')} AS tick, CASE WHEN fresh AND value = 1 THEN 'UP' ELSE 'DOWN' END AS state,
               CASE WHEN fresh THEN {_TS.format('ts')} END AS last_seen
        FROM (SELECT g.user_id, tick, s.ts, value, coalesce(tick - s.ts <= INTERVAL {_GRID}, false) AS fresh
              FROM g ASOF LEFT JOIN s ON g.user_id = s.user_id AND s.ts <= g.tick)
    """,
    "job_timeouts": f"""
        WITH e AS (SELECT user_id AS job_id, date_trunc('millisecond', ts) AS t, {STATUS_SQL} AS status,
                          row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('millisecond', ts), event_id) AS i FROM events),
        f AS (SELECT *, lead(t) OVER (PARTITION BY job_id ORDER BY i) AS next, max(t) OVER () AS now,
                     status IN ('SUCCEEDED', 'FAILED', 'STOPPED') AS terminal FROM e),
        x AS (SELECT *, CASE WHEN terminal THEN status ELSE 'TIMED_OUT' END AS outcome,
                     CASE WHEN terminal THEN t ELSE t + INTERVAL 12 HOUR END AS ended FROM f
              WHERE terminal OR coalesce(next, now) - t > INTERVAL 12 HOUR
              QUALIFY i = min(i) OVER (PARTITION BY job_id))
        SELECT job_id, outcome, {_TS.format('ended')} AS ended_at, status AS last_status FROM x
    """,
}

"""Metric samples, job states, and the streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.operators import models, rollups, scoring
from kilnwork.plans.inference import PREDICTIONS_SQL, flat_predictions, mean_model, with_path
from kilnwork.plans.inputs import STATUS_OF_EVENT, STATUS_SQL, job_events as job_event_rows, samples, table
from kilnwork.session import scratch_path
from kilnwork.sources import tables
from kilnwork.streaming import endings, streams

_USER_TYPES = ("click", "view", "signup")


def _metric_rows(events: DataFrame, ts=None) -> DataFrame:
    return tables.metric_samples(
        events,
        ts=F.col("ts") if ts is None else ts,
        metric=F.col("event_type"),
        value=F.col("value"),
        labels={"user": F.col("user_id"), "k": F.get_json_object("props", "$.k")},
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _metric_rows(table(spark, sf_dir, "events"))
    return rows.select(
        F.col("ts").cast("string").alias("ts"),
        "metric",
        F.col("labels")["user"].alias("label_user"),
        F.col("labels")["k"].alias("label_k"),
        "value",
    )


def metric_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static labels for all samples; the customer's segment as the label of a target."""
    events = table(spark, sf_dir, "events")
    rows = events.select("event_id", F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("labels"), "user_id")
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.create_map(F.lit("segment"), "c_mktsegment", F.lit("component"), F.lit("customer")).alias("target_labels"),
    )
    static = {"monitor": "cluster-monitor", "component": "head"}
    labelled = rollups.attach_labels(rows, static, segments, target="user_id")
    names = ("k", "segment", "monitor", "component")
    return labelled.select(
        "event_id", *[F.try_element_at("labels", F.lit(name)).alias(name) for name in names]
    )


def metric_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    # An event without a type is no user's.
    is_user = F.coalesce(F.col("event_type").isin(*_USER_TYPES), F.lit(False))
    return rollups.union_metrics({"users": events.filter(is_user), "system": events.filter(~is_user)})


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").cast("string").alias("window_start"),
        "metric",
        "samples",
        F.round("sum_value", 4).alias("sum_value"),
        "min_value",
        "max_value",
    )


def metric_tumble_15s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(rollups.tumbling(_metric_rows(table(spark, sf_dir, "events"))))


def target_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is down when the last event is an error."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "ts", F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value")
    )
    up = rollups.target_up(rows, "user_id")
    return up.withColumn("last_seen", F.col("last_seen").cast("string"))


def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.ready_total(job_event_rows(spark, sf_dir), "job_id", F.col("status") == "RUNNING")


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_event_rows(spark, sf_dir).withColumn("ts", F.col("ts").cast("string"))


def job_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.latest_status(job_event_rows(spark, sf_dir)).withColumn("ts", F.col("ts").cast("string"))


def job_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.with_outcome(rollups.latest_status(job_event_rows(spark, sf_dir))).drop("ts")


def _arrivals(sf_dir: str, name: str) -> str:
    """A file stream takes a folder or, as here, a pattern, which also matches a table that is one file."""
    return f"{sf_dir}/{{{name}.parquet}}"


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.file_stream(spark, _arrivals(sf_dir, "events"), table(spark, sf_dir, "events").schema)


def stream_tumble_15s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a stream: those that became final by its samples, and those that the end of the stream closes."""
    out, state, ends = (scratch_path(spark, name) for name in ("windows", "windows-state", "ends"))
    rows = _metric_rows(_event_stream(spark, sf_dir), ts=streams.as_instant(F.col("ts")))
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window.start").cast("timestamp_ntz"))

    def flat() -> DataFrame:
        return streams.windowed_metrics(endings.with_endings(rows, ends)).withColumn("window_start", start).drop("window")

    endings.run_to_end(lambda: streams.run_to_table(flat(), out, state), spark, ends)
    return spark.read.schema(flat().schema).parquet(out).select(
        F.col("window_start").cast("string").alias("window_start"),
        "metric",
        "samples",
        F.round("sum_value", 4).alias("sum_value"),
        "min_value",
        "max_value",
    )


def stream_job_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "jobs")
    events = tables.job_events(
        _event_stream(spark, sf_dir),
        job_id=F.col("user_id"),
        seq=F.col("event_id"),
        ts=F.col("ts"),
        status=tables.mapped(F.col("event_type"), STATUS_OF_EVENT),
        log=F.col("props"),
    )
    streams.track_jobs(events, out, scratch_path(spark, "jobs-state")).awaitTermination()
    return streams.tracked_jobs(spark, out).withColumn("ts", F.col("ts").cast("string"))


def stream_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "scores")
    arriving = streams.file_stream(spark, _arrivals(sf_dir, "embeddings"), samples(spark, sf_dir).schema)
    model = mean_model(spark, sf_dir)
    scored = scoring.score(
        with_path(arriving).select("vec_id", "path", "embedding"),
        models.broadcast_loader(spark, model),
        scoring.vector_features("embedding", model.weights.shape[1]),
        keep=["vec_id"],
        batch_size=4096,
    )
    streams.run_to_table(scored, out, scratch_path(spark, "scores-state")).awaitTermination()
    return flat_predictions(spark.read.schema(scored.schema).parquet(out))


QUERIES = {
    "metric_samples": metric_samples,
    "metric_labels": metric_labels,
    "metric_union": metric_union,
    "metric_tumble_15s": metric_tumble_15s,
    "target_up": target_up,
    "status_rollup": status_rollup,
    "job_events": job_events,
    "job_latest": job_latest,
    "job_terminal": job_terminal,
    "stream_tumble_15s": stream_tumble_15s,
    "stream_job_latest": stream_job_latest,
    "stream_inference": stream_inference,
}

# Spark prints a timestamp without the zeros at the end of its fraction.
_TS = """
    CASE WHEN microsecond({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S')
         ELSE rtrim(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '0') END
"""
_WINDOWS = """
    SELECT time_bucket(INTERVAL 15 SECOND, ts) AS w, event_type AS metric, count(*) AS samples,
           round(sum(value), 4) AS sum_value, min(value) AS min_value, max(value) AS max_value
    FROM events GROUP BY 1, 2
"""
_WINDOW_COLUMNS = "strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, metric, samples, sum_value, min_value, max_value"
_LATEST = f"""
    SELECT user_id AS job_id, arg_max({STATUS_SQL}, row(ts, event_id)) AS status, max(ts) AS last_ts
    FROM events GROUP BY 1
"""
_JOB_LATEST = f"SELECT job_id, status, {_TS.format('last_ts')} AS ts FROM ({_LATEST})"

ORACLES = {
    "metric_samples": f"""
        SELECT {_TS.format('ts')} AS ts, event_type AS metric, user_id::VARCHAR AS label_user,
               json_extract_string(props, '$.k') AS label_k, value
        FROM events
    """,
    "metric_labels": """
        SELECT event_id, json_extract_string(props, '$.k') AS k, c_mktsegment AS segment,
               'cluster-monitor' AS monitor,
               CASE WHEN c_custkey IS NULL THEN 'head' ELSE 'customer' END AS component
        FROM events LEFT JOIN customer ON c_custkey = user_id
    """,
    "metric_union": """
        SELECT event_id, event_type, value,
               CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'users' ELSE 'system' END AS job
        FROM events
    """,
    "metric_tumble_15s": f"SELECT {_WINDOW_COLUMNS} FROM ({_WINDOWS})",
    "stream_tumble_15s": f"SELECT {_WINDOW_COLUMNS} FROM ({_WINDOWS})",
    "target_up": f"""
        SELECT user_id, CASE WHEN arg_max(event_type, (ts, event_type <> 'error')) = 'error' THEN 'DOWN' ELSE 'UP' END AS state,
               {_TS.format('max(ts)')} AS last_seen
        FROM events GROUP BY 1
    """,
    "status_rollup": """
        SELECT user_id AS job_id, count(*) FILTER (event_type = 'click') AS ready, count(*) AS total
        FROM events GROUP BY 1
    """,
    "job_events": f"""
        SELECT user_id AS job_id, event_id AS seq, {_TS.format('ts')} AS ts, {STATUS_SQL} AS status, props AS log
        FROM events
    """,
    "job_latest": _JOB_LATEST,
    "stream_job_latest": _JOB_LATEST,
    "stream_inference": PREDICTIONS_SQL,
    "job_terminal": f"""
        SELECT job_id, status, status IN ('SUCCEEDED', 'FAILED', 'STOPPED') AS terminal,
               CASE WHEN status = 'SUCCEEDED' THEN 'success' WHEN status IN ('FAILED', 'STOPPED') THEN 'failure'
                    ELSE 'pending' END AS outcome
        FROM ({_LATEST})
    """,
}

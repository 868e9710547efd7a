"""How the given tables stand in for samples, trials, jobs, metrics and objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.sources import tables

FIRST_DAY = "2024-01-01"
STATUS_OF_EVENT = {
    "purchase": "SUCCEEDED",
    "error": "FAILED",
    "signup": "STOPPED",
    "click": "RUNNING",
    "view": "PENDING",
}
# Object names get one of these endings in turn.
ENDINGS = (".jpg", ".JPEG", ".png", ".bmp", ".tiff", ".webp", ".tif", ".gif", ".txt", ".csv", ".json", ".TXT", "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.parquet(spark, f"{sf_dir}/{name}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as reports: user = trial, day = iteration, cents up to 10,000 = correct of 10,000."""
    cents = F.least(F.round(F.col("value") * 100).cast("long"), F.lit(10_000))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("trial_id"),
        (F.datediff(F.col("ts"), F.lit(FIRST_DAY).cast("date")) + 1).alias("training_iteration"),
        cents.alias("correct"),
        F.lit(10_000).cast("long").alias("total"),
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return tables.job_events(
        events,
        job_id=F.col("user_id"),
        seq=F.col("event_id"),
        ts=F.col("ts"),
        status=tables.mapped(F.col("event_type"), STATUS_OF_EVENT),
        log=F.col("props"),
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as stored objects with a name and UTF-8 content."""
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (F.col("doc_id") % len(ENDINGS) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws("/", "lang", "source", F.concat(F.col("doc_id").cast("string"), ending)).alias("path"),
        F.encode("text", "UTF-8").alias("content"),
    )


# The same tables for the oracles.
METRICS_SQL = f"""
    SELECT user_id AS trial_id, date_diff('day', DATE '{FIRST_DAY}', ts::DATE) + 1 AS training_iteration,
           sum(least(round(value * 100)::BIGINT, 10000)) / sum(10000) AS mean_accuracy
    FROM events GROUP BY 1, 2
"""
STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_OF_EVENT.items()) + " END"
OBJECTS_SQL = f"""
    SELECT doc_id, lang || '/' || source || '/' || doc_id
               || ([{', '.join(repr(e) for e in ENDINGS)}])[doc_id % {len(ENDINGS)} + 1] AS path,
           text, octet_length(encode(text)) AS size
    FROM documents
"""

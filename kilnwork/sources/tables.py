"""Tables of metric samples, job events and labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def parquet(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.parquet(uri)


def metric_samples(
    df: DataFrame, ts: Column, metric: Column, value: Column, labels: dict[str, Column] | None = None
) -> DataFrame:
    """``ts, metric, labels, value`` from any table, batch or streaming."""
    pairs = [x for name, label in (labels or {}).items() for x in (F.lit(name), label.cast("string"))]
    none = F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")
    return df.select(
        ts.alias("ts"),
        metric.alias("metric"),
        (F.create_map(*pairs) if pairs else none).alias("labels"),
        value.cast("double").alias("value"),
    )


def job_events(df: DataFrame, job_id: Column, seq: Column, ts: Column, status: Column, log: Column) -> DataFrame:
    """``job_id, seq, ts, status, log``; ``seq`` orders the events of one instant."""
    return df.select(
        job_id.cast("long").alias("job_id"),
        seq.cast("long").alias("seq"),
        ts.alias("ts"),
        status.alias("status"),
        log.alias("log"),
    )


def mapped(source: Column, mapping: dict[str, str]) -> Column:
    """Replace values by a fixed mapping, NULL for others."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), source)

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.operators import models, rollups, scoring
from kilnwork.streaming import streams

T0 = dt.datetime(2024, 1, 1)
EVENTS = "job_id long, seq long, ts timestamp_ntz, status string, log string"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_windows_of_a_stream_equal_the_batch_once_final(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts timestamp_ntz, metric string, value double"
    rows = [(at(i * 7), "ab"[i % 2], float(i)) for i in range(400)]
    spark.createDataFrame(rows, schema).repartitionByRange(4, "ts").write.parquet(source)
    batch = spark.read.parquet(source).withColumn("ts", streams.as_instant(F.col("ts")))
    arriving = streams.file_stream(spark, source, spark.read.parquet(source).schema)
    windows = streams.windowed_metrics(arriving.withColumn("ts", streams.as_instant(F.col("ts"))), watermark="1 minute")
    flat = windows.select(F.col("window.end").alias("ends"), "metric", "samples", "sum_value")
    streams.run_to_table(flat, out, str(tmp_path / "cp")).awaitTermination()
    want = rollups.tumbling(batch).select(F.col("window.end").alias("ends"), "metric", "samples", "sum_value")
    final = want.filter(F.col("ends") <= F.lit(max(r[0] for r in rows) - dt.timedelta(minutes=1)))
    got = spark.read.parquet(out)
    assert got.count() == final.count() > 300
    assert got.exceptAll(final).count() == 0
    left = streams.windows_left(batch, watermark="1 minute").select(F.col("window.end").alias("ends"), "metric", "samples", "sum_value")
    assert got.unionByName(left).exceptAll(want).count() == 0 and got.count() + left.count() == want.count()


@pytest.mark.parametrize("compact_every", [1, 2, 100])
def test_job_states_follow_arriving_files(spark, tmp_path, compact_every):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    ended = []

    def poll():
        stream = streams.file_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
        streams.track_jobs(
            stream, out, checkpoint, lambda df, _: ended.extend(r["job_id"] for r in df.collect()), compact_every
        ).awaitTermination()
        return {r["job_id"]: r["status"] for r in streams.tracked_jobs(spark, out).collect()}

    def arrive(rows):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)

    arrive([(1, 1, at(0), "PENDING", ""), (2, 2, at(0), "RUNNING", "")])
    assert poll() == {1: "PENDING", 2: "RUNNING"} and ended == []
    arrive([(1, 3, at(9), "SUCCEEDED", "")])
    arrive([(2, 4, at(9), "RUNNING", ""), (3, 5, at(9), "STOPPED", ""), (1, 0, at(1), "RUNNING", "late")])
    assert poll() == {1: "SUCCEEDED", 2: "RUNNING", 3: "STOPPED"}
    assert set(ended) == {1, 3}
    assert poll() == {1: "SUCCEEDED", 2: "RUNNING", 3: "STOPPED"}


def test_streaming_scores_equal_batch_scores(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 4)))]
    spark.createDataFrame(rows, "id long, x array<float>").repartition(3).write.parquet(source)
    model = models.LinearModel(rng.normal(size=(7, 4)), np.zeros(7))
    loader = models.broadcast_loader(spark, model)

    def scored(df):
        return scoring.score(df, loader, scoring.vector_features("x", 4), keep=["id"])

    batch = scored(spark.read.parquet(source))
    stream = scored(streams.file_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1))
    streams.run_to_table(stream, out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(batch.schema).parquet(out)
    assert got.count() == 60 and got.exceptAll(batch).count() == 0


def test_folders_and_state_stay_bounded(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    for i in range(12):
        rows = [(i, 2 * i, at(i * 3600), "RUNNING", ""), (i - 1, 2 * i + 1, at(i * 3600), "SUCCEEDED", "")]
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
        streams.track_jobs(stream, out, checkpoint, compact_every=3, forget_after="4 hours").awaitTermination()
    folders = [p for kind in ("change", "whole") for p in (tmp_path / "out" / f"kind={kind}").glob("batch=*")]
    assert len(folders) <= 2 * 3 + 2
    states = {r["job_id"]: r["status"] for r in streams.tracked_jobs(spark, out).collect()}
    assert states[11] == "RUNNING" and states[10] == "SUCCEEDED" and 0 not in states and len(states) <= 8

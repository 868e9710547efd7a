import datetime as dt

from pyspark.sql import functions as F

from kilnwork.operators import rollups
from kilnwork.sources import tables

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_stage_counts(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, False), (None, None)], "image boolean, scored boolean")
    assert rollups.stage_counts(df, F.col("image"), df.filter("scored")).first().asDict() == {
        "loaded": 4,
        "images": 2,
        "predictions": 1,
    }


def test_latest_status_breaks_ties_by_sequence(spark):
    rows = [(1, 1, at(0), "PENDING", ""), (1, 3, at(5), "FAILED", ""), (1, 2, at(5), "RUNNING", ""), (2, 9, at(1), "SUCCEEDED", "")]
    events = spark.createDataFrame(rows, "job_id long, seq long, ts timestamp_ntz, status string, log string")
    got = rollups.with_outcome(rollups.latest_status(events)).collect()
    assert {r["job_id"]: (r["status"], r["terminal"], r["outcome"]) for r in got} == {
        1: ("FAILED", True, "failure"),
        2: ("SUCCEEDED", True, "success"),
    }


def test_labels_of_the_sample_win(spark):
    samples = spark.createDataFrame(
        [("cpu", {"component": "worker"}), ("mem", {}), ("disk", {"x": "1"})], "metric string, labels map<string,string>"
    )
    targets = spark.createDataFrame(
        [("cpu", {"component": "t", "rack": "1"}), ("mem", {"monitor": "own"})], "metric string, target_labels map<string,string>"
    )
    got = rollups.attach_labels(samples, {"monitor": "m", "component": "head"}, targets)
    assert {r["metric"]: r["labels"] for r in got.collect()} == {
        "cpu": {"component": "worker", "rack": "1", "monitor": "m"},
        "mem": {"monitor": "own", "component": "head"},
        "disk": {"x": "1", "monitor": "m", "component": "head"},
    }
    assert rollups.attach_labels(samples, {}).filter("metric = 'mem'").first()["labels"] == {}


def test_union_of_scrape_jobs(spark):
    one = spark.createDataFrame([("a", 1.0)], "metric string, value double")
    two = spark.createDataFrame([(2.0, "b")], "value double, metric string")
    got = rollups.union_metrics({"first": one, "second": two}).collect()
    assert {(r["job"], r["metric"], r["value"]) for r in got} == {("first", "a", 1.0), ("second", "b", 2.0)}


def test_tumbling_windows_start_on_the_interval(spark):
    df = spark.createDataFrame([(at(0), "m", 1.0), (at(14.9), "m", 2.0), (at(15), "m", 4.0)], "ts timestamp_ntz, metric string, value double")
    got = {r["window"]["start"]: (r["samples"], r["sum_value"], r["max_value"]) for r in rollups.tumbling(df).collect()}
    assert got == {at(0): (2, 3.0, 2.0), at(15): (1, 4.0, 4.0)}


def test_target_state(spark):
    df = spark.createDataFrame([("a", at(0), 1.0), ("a", at(1), 0.0), ("b", at(1), 1.0), ("b", at(0), 0.0)], "t string, ts timestamp_ntz, value double")
    assert {r["t"]: r["state"] for r in rollups.target_up(df, "t").collect()} == {"a": "DOWN", "b": "UP"}


def test_ready_total(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "k string, r int")
    assert {tuple(r) for r in rollups.ready_total(df, "k", F.col("r") == 1).collect()} == {("a", 1, 2), ("b", 0, 1)}


def test_samples_without_labels(spark):
    df = spark.createDataFrame([(at(0), 1)], "ts timestamp_ntz, v int")
    row = tables.metric_samples(df, F.col("ts"), F.lit("m"), F.col("v")).first()
    assert row["labels"] == {} and row["value"] == 1.0


def test_mapped(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    assert [r[0] for r in df.select(tables.mapped(F.col("s"), {"a": "A"})).collect()] == ["A", None, None]

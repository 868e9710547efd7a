"""Reports, scrapes, logs, targets and jobs as they arrive."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kilnwork.functions import exposition
from kilnwork.operators import async_halving, logs, rollups, search
from kilnwork.operators.async_halving import Rungs
from kilnwork.sources import scrapes
from kilnwork.streaming import endings, polls, searches, streams

T0 = dt.datetime(2024, 1, 1)
REPORTS = "search_id long, trial_id long, ts timestamp_ntz, seq long, mean_accuracy double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def naive_async(rows, levels=(1, 4, 16, 64), q=0.75):
    out, seen, count, gone = [], {}, {}, set()
    for s, t, _, _, m in sorted(rows, key=lambda r: (r[2], r[3])):
        n = count[s, t] = count.get((s, t), 0) + 1
        if n not in levels or (s, t) in gone:
            continue
        before = seen.setdefault((s, n), [])
        cut = float(np.quantile(before, q)) if before else None
        fine = m is not None and math.isfinite(m)
        keep = fine and (cut is None or m >= cut)
        if fine:
            before.append(m)
        if not keep:
            gone.add((s, t))
        out.append((s, t, n, m, cut, keep))
    return out


def reports(seed, searches=5, trials=12, n=1500):
    r = random.Random(seed)
    odd = [None, float("nan"), float("inf")]
    rows = []
    for i in range(n):
        s = 0 if r.random() < 0.4 else r.randrange(searches)  # one search has most of the reports
        t = 100 * s if r.random() < 0.3 else 100 * s + r.randrange(trials)  # and so has one trial of each
        rows.append((s, t, at(i // 3), i, odd[i % 3] if r.random() < 0.02 else float(r.randrange(40))))
    return rows


def verdicts(df):
    def flat(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(flat(v) for v in r) for r in map(tuple, df.collect())), key=repr)


def want_verdicts(rows):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in naive_async(rows)), key=repr)


def test_async_rungs_of_a_batch(spark):
    rows = reports(1)
    got = async_halving.halving_async(spark.createDataFrame(rows, REPORTS).repartition(7))
    assert verdicts(got) == want_verdicts(rows)
    assert async_halving.halving_async(spark.createDataFrame([], REPORTS)).count() == 0


def test_async_rungs_of_a_stream_restarted_at_every_file(spark, tmp_path):
    rows, source, out, checkpoint = reports(2), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    for part in range(5):
        spark.createDataFrame(rows[part * 300 : part * 300 + 300], REPORTS).coalesce(1).write.mode("append").parquet(source)
        judged = searches.schedule_async(streams.file_stream(spark, source, spark.read.parquet(source).schema))
        streams.run_to_table(judged, out, checkpoint).awaitTermination()
    got = spark.read.schema(judged.schema).parquet(out)
    # Values that are missing come back from pandas as NaN or NULL alike.
    blank = lambda rs: sorted(((*r[:3], None if r[3] in ("nan", None) else r[3], *r[4:]) for r in rs), key=repr)
    assert blank(verdicts(got)) == blank(want_verdicts(rows))


def test_rung_states_merge_and_travel():
    a, b = Rungs(), Rungs()
    for i, m in enumerate([3.0, 1.0, 2.0]):
        a.judge(i, 1, m)
        b.judge(10 + i, 1, m + 0.5)
    both = Rungs.from_json(a.merged(b).to_json())
    assert both.values == {1: [1.0, 1.5, 2.0, 2.5, 3.0, 3.5]} and both.stopped == a.stopped | b.stopped
    assert both.cut(1) == np.quantile(both.values[1], 0.75)
    assert both.judge(99, 1, both.cut(1)) == (2.875, True) and both.judge(1, 4, 9.0) is None


def test_a_search_whose_trials_do_not_wait(spark, tmp_path, monkeypatch):
    from kilnwork.operators import sampling, training
    from kilnwork.sinks import checkpoints

    r = np.random.default_rng(3)
    rows = [(i, [float(v) for v in r.normal(size=3)], int(r.integers(4))) for i in range(300)]
    samples = sampling.split_train_test(spark.createDataFrame(rows, "id long, x array<double>, y int"), "id")
    trainable = training.SoftmaxRegression(3, 4, 0.5)
    options = dict(key="id", features="x", label="y", max_iterations=18, target=2.0)
    trials = search.param_space(spark, 24)

    def reports(found):
        return sorted((t, i, m) for t, i, m, _ in found.reports)

    whole = search.run_search(samples, trials, trainable, rule=async_halving.arrival_rule(), **options)
    by = {}
    for t, i, m in reports(whole):
        by.setdefault(i, {})[t] = m
    for level in (1, 4, 16):
        seen, going = [], set()
        for t, m in sorted(by[level].items()):
            if not seen or m >= np.quantile(seen, 0.75):
                going.add(t)
            seen.append(m)
        assert set(by[level + 1]) == going
    # Killed in its sixth iteration, as its checkpoint is written, and taken up again.
    path, write, calls = str(tmp_path / "cp"), checkpoints.write, []

    def dies(*args, **named):
        calls.append(1)
        if len(calls) == 6:
            raise KeyboardInterrupt
        write(*args, **named)

    monkeypatch.setattr(checkpoints, "write", dies)
    with pytest.raises(KeyboardInterrupt):
        search.run_search(samples, trials, trainable, rule=async_halving.arrival_rule(), checkpoint_path=path, **options)
    monkeypatch.setattr(checkpoints, "write", write)
    again = search.run_search(samples, trials, trainable, rule=async_halving.arrival_rule(), checkpoint_path=path, resume=True, **options)
    assert [(t, i) for t, i, _ in reports(again)] == [(t, i) for t, i, _ in reports(whole)]
    assert np.allclose([m for *_, m in reports(again)], [m for *_, m in reports(whole)])


def test_more_trials_than_a_search_holds_are_refused(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_TRIALS", 3)
    with pytest.raises(Exception, match="at most 3 trials"):
        async_halving.halving_async(spark.createDataFrame([(1, i, at(i), i, 1.0) for i in range(4)], REPORTS)).collect()


LINES = [
    ("up 1", ("up", {}, 1.0, None, None)),
    ("  http_requests_total{method=\"post\",code=\"200\"} 1027 1395066363000 ", ("http_requests_total", {"method": "post", "code": "200"}, 1027.0, 1395066363000, None)),
    ('m{path="C:\\\\DIR\\\\n",error="Cannot \\"open\\"\\nfile}, {x=1"} 1.5e3', ("m", {"path": "C:\\DIR\\n", "error": 'Cannot "open"\nfile}, {x=1'}, 1500.0, None, None)),
    ("a:b{} NaN", ("a:b", {}, math.nan, None, None)),
    ("a{x=\"1\",} +Inf -5", ("a", {"x": "1"}, math.inf, -5, None)),
    ("a { x = \"1\" , y = \"\" } -Inf", ("a", {"x": "1", "y": ""}, -math.inf, None, None)),
    ("a{x=\"1\",x=\"2\"} 0", ("a", {"x": "1"}, 0.0, None, None)),
    ("a{x=\"\u0001é漢\"}\t7\t8\r", ("a", {"x": "\u0001é漢"}, 7.0, 8, None)),
    ("a{v=\"" + "x\\\\" * 20_000 + "\"} 1", ("a", {"v": "x\\" * 20_000}, 1.0, None, None)),
    ("a", "not a sample"), ("1a 2", "not a sample"), ("a{x=1} 2", "not a sample"), ("a{x=\"1} 2", "not a sample"), ("a{x=\"1\"}", "not a sample"),
    ("a{x=\"1\" y=\"2\"} 1", "not a sample"), ("a one", "not a number"), ("a 1 2 3", "not a sample"), ("a 1 99999999999999999999", "not a time"), ("a1", "not a sample"),
]


def test_lines_of_the_text_format(spark):
    notes = [("",), ("   ",), ("# HELP a What\\nit \\\\ is",), ("#TYPE a counter",), ("# TYPE a  gauge ",), ("# any comment",)]
    df = spark.createDataFrame([(line, i) for i, (line, _) in enumerate(LINES)] + [(n[0], 1000 + i) for i, n in enumerate(notes)], "value string, target int")
    got = {r["target"]: r for r in scrapes.parsed_lines(df).withColumn("ms", F.unix_millis("ts")).collect()}
    assert set(got) == set(range(len(LINES)))
    for i, (line, want) in enumerate(LINES):
        r = got[i]
        if isinstance(want, str):
            assert (r["metric"], r["labels"], r["value"], r["ts"], r["error"]) == (None, None, None, None, want), line
        else:
            have = (r["metric"], r["labels"], r["value"], r["ms"], r["error"])
            assert have[:2] == want[:2] and have[3:] == want[3:] and (have[2] == want[2] or math.isnan(want[2]) and math.isnan(have[2])), line
    assert [tuple(r) for r in scrapes.described(df).collect()] == [("a", "gauge", "What\nit \\ is")]


def test_samples_written_and_read_back(spark):
    rows = [("m", {"a": 'x"y\\n\n', "b": ""}, 0.1 + 0.2), ("n", {}, 1e-300), ("o", {"c": "\\"}, -0.0)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, value double")
    lines = df.select(exposition.exposed(F.col("metric"), F.col("labels"), F.col("value")).alias("value"), F.lit("t").alias("target"))
    assert sorted((r["metric"], r["labels"], r["value"]) for r in scrapes.parsed_lines(lines).collect()) == sorted(rows)


def test_targets_are_scraped_by_tasks(spark, tmp_path):
    for name, body in (("a", "x 1\n# c\ny{l=\"v\"} 2 1000\nbad line here\n"), ("b", "x 3\n"), ("long", "x 1\n" * 100)):
        (tmp_path / name).write_text(body)
    urls = [f"file://{tmp_path}/{n}" for n in ("a", "b", "long", "missing")]
    answers = scrapes.scrape(spark, urls, maxBytes="50")
    assert answers.rdd.getNumPartitions() == len(urls)
    found = scrapes.answered_samples(answers).withColumn("ms", F.unix_millis("ts")).collect()
    up = {r["target"].rsplit("/")[-1]: r["value"] for r in found if r["metric"] == "up"}
    assert up == {"a": 1.0, "b": 1.0, "long": 0.0, "missing": 0.0}
    rest = sorted((r["target"][-1], r["metric"] or "", r["value"] or 0.0, r["error"] or "") for r in found if r["metric"] != "up")
    assert rest == [("a", "", 0.0, "not a sample"), ("a", "x", 1.0, ""), ("a", "y", 2.0, ""), ("b", "x", 3.0, "")]
    assert [r["ms"] for r in found if r["metric"] == "y"] == [1000]
    with pytest.raises(Exception, match="targets"):
        scrapes.scrape(spark, []).collect()


def test_targets_are_scraped_as_a_stream(spark, tmp_path):
    (tmp_path / "a").write_text("x 1\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for value in (1, 2):
        (tmp_path / "a").write_text(f"x {value}\n")
        answers = scrapes.scrape(spark, [f"file://{tmp_path}/a"], stream=True, interval="0.001")
        query = answers.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).start()
        query.processAllAvailable() if value == 0 else None
        for _ in range(200):
            if query.lastProgress and query.lastProgress["numInputRows"]:
                break
            query.awaitTermination(0.2)
        query.stop()
    samples = scrapes.answered_samples(spark.read.schema(answers.schema).parquet(out))
    assert {r["value"] for r in samples.filter("metric = 'x'").collect()} == {1.0, 2.0}


def test_folders_of_scrapes_as_batch_and_stream(spark, tmp_path):
    lines = [(f"n{i % 3}", f'm{{i="{i}"}} {i} {i * 1000}') for i in range(90)] + [("n0", "# HELP m text"), ("n1", "broken{")]
    path = str(tmp_path / "in")
    spark.createDataFrame(lines, "target string, line string").repartition(4).write.partitionBy("target").text(path)
    batch = scrapes.parsed_lines(scrapes.scrape_folder(spark, path))
    stream = scrapes.parsed_lines(scrapes.scrape_folder(spark, path, stream=True))
    streams.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    flat = lambda df: sorted(df.select("target", "metric", F.to_json("labels"), "value", "ts", "error").collect(), key=repr)
    assert flat(batch) == flat(spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))) and batch.count() == 91


@pytest.mark.parametrize("chars", [1, 7, 1024])
def test_tails_of_logs_in_parts(spark, chars):
    r = random.Random(chars)
    rows = [(r.choice([1, 1, 1, 2, 3, None]), i, r.choice(["", None, "é" * r.randrange(30), f"line {i}\n", "x" * 3000 if i % 97 == 0 else "y"])) for i in range(2000)]
    rows += [(7, None, "first"), (7, 0, "second"), (8, 0, None), (9, None, "")]
    whole = {}
    for key, order, text in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0)):
        whole[key] = whole.get(key, "") + (text or "")
    df = spark.createDataFrame(rows, "job long, part long, log string").repartition(5)
    got = {x["job"]: x["tail"] for x in logs.tail_of_parts(df, "job", "part", "log", chars).collect()}
    assert got == {k: v[-chars:] for k, v in whole.items()}
    equal = spark.createDataFrame([(1, 1, t) for t in "abcabc" * 50], "job long, part long, log string")
    tails = {logs.tail_of_parts(equal.repartition(n), "job", "part", "log", 40).first()["tail"] for n in (1, 3, 6)}
    assert len(tails) == 1
    assert logs.tail_of_parts(df.limit(0), "job", "part", "log").count() == 0


def test_silent_targets_are_down(spark):
    r = random.Random(5)
    rows = [(r.choice("aaab"), at(r.randrange(0, 1200)), float(r.random() < 0.8)) for _ in range(60)] + [("c", at(30), 1.0), ("c", at(600), 0.0), (None, at(45), 1.0)]
    df = spark.createDataFrame(rows, "target string, ts timestamp_ntz, value double")
    for stale, life in ((None, 15), ("1 minute", 60), ("5 seconds", 5)):
        got = {(x["target"], x["tick"]): (x["state"], x["last_seen"]) for x in rollups.target_up_grid(df.withColumn("ts", streams.as_instant(F.col("ts"))), "target", stale=stale).withColumn("tick", F.col("tick").cast("timestamp_ntz")).withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz")).collect()}
        seconds = [int((t - T0).total_seconds()) for _, t, _ in rows]
        ticks = range(-(-min(seconds) // 15) * 15, -(-max(seconds) // 15) * 15 + 1, 15)
        want = {}
        for target in {t for t, _, _ in rows}:
            for tick in ticks:
                last = max(((ts, v) for t, ts, v in rows if t == target and at(tick - life) <= ts <= at(tick)), default=None)
                want[target, at(tick)] = ("UP" if last and last[1] else "DOWN", last[0] if last else None)
        assert got == want
    assert rollups.target_up_grid(df.limit(0), "target").count() == 0


def naive_endings(rows, patience, now):
    out, jobs = {}, {}
    for job, seq, ts, status in sorted(rows, key=lambda r: (r[2], r[1])):
        jobs.setdefault(job, []).append((ts, status))
    for job, held in jobs.items():
        for i, (ts, status) in enumerate(held):
            if status in ("SUCCEEDED", "FAILED", "STOPPED"):
                out[job] = (status, ts, status)
                break
            if (held[i + 1][0] if i + 1 < len(held) else now) - ts > patience:
                out[job] = (polls.TIMED_OUT, ts + patience, status)
                break
    return out


@pytest.mark.parametrize("files", [1, 6])
def test_jobs_that_stop_reporting_time_out(spark, tmp_path, files):
    r = random.Random(files)
    rows, source, out = [], str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(400):
        job = 0 if r.random() < 0.3 else r.randrange(1, 40)
        rows.append((job, i, at(i * 60), r.choice(["RUNNING", "RUNNING", "PENDING"] + ["SUCCEEDED", "FAILED"] * (r.random() < 0.1))))
    rows += [(50, 900, at(10), "RUNNING"), (51, 901, at(23_000), None), (52, 902, at(23_930), "PENDING")]
    rows.sort(key=lambda x: x[2])
    schema, patience = "job_id long, seq long, ts timestamp_ntz, status string", dt.timedelta(minutes=30)
    ends, checkpoint = str(tmp_path / "ends"), str(tmp_path / "cp")

    def start():  # a new query from the checkpoint each time, as after a restart
        arriving = streams.file_stream(spark, source, spark.createDataFrame([], schema).schema).withColumn("ts", streams.as_instant(F.col("ts")))
        return streams.run_to_table(polls.job_endings(endings.with_endings(arriving, ends), patience, "1 minute"), out, checkpoint)

    size = -(-len(rows) // files)
    for part in range(files):
        spark.createDataFrame(rows[part * size : part * size + size], schema).coalesce(1).write.mode("append").parquet(source)
        if part < files - 1:
            start().awaitTermination()
    now = max(x[2] for x in rows)
    closing = (now + dt.timedelta(minutes=1, milliseconds=1)).replace(tzinfo=dt.timezone.utc)
    endings.run_to_end(start, spark, ends, lambda: closing)
    got = {x["job_id"]: (x["outcome"], x["ended_at"], x["last_status"]) for x in spark.read.schema(polls.ENDED).parquet(out).withColumn("ended_at", F.col("ended_at").cast("timestamp_ntz")).collect()}
    want = naive_endings(rows, patience, now)
    assert got == want and 52 not in got and any(v[0] == polls.TIMED_OUT for v in got.values()) and any(v[0] != polls.TIMED_OUT for v in got.values())


def test_windows_left_at_the_end_come_from_the_stream(spark, tmp_path):
    source, out, ends = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ends")
    schema = "ts timestamp_ntz, metric string, value double"
    rows = [(at(i * 7), "ab"[i % 2], float(i)) for i in range(400)]
    spark.createDataFrame(rows, schema).repartitionByRange(4, "ts").write.parquet(source)

    def start():
        arriving = streams.file_stream(spark, source, spark.createDataFrame([], schema).schema).withColumn("ts", streams.as_instant(F.col("ts")))
        return streams.run_to_table(streams.windowed_metrics(endings.with_endings(arriving, ends)), out, str(tmp_path / "cp"))

    endings.run_to_end(start, spark, ends)
    batch = rollups.tumbling(spark.read.parquet(source).withColumn("ts", streams.as_instant(F.col("ts"))))
    got = spark.read.schema(batch.schema).parquet(out)
    assert got.exceptAll(batch).count() == 0 and got.count() == batch.count()

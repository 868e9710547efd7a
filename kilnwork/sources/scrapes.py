"""Scraped metrics: targets that are asked, and folders of what they answered."""

from __future__ import annotations

import datetime as dt
import time
import urllib.request
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from kilnwork.functions import exposition

# Seconds between scrapes, and until a target counts as down.
SCRAPE_SECONDS, TIMEOUT_SECONDS = 15, 10
MAX_BYTES = 64 << 20

_ANSWERS = "target string, scraped_at timestamp, body string, error string"


class Target(InputPartition):
    def __init__(self, url: str):
        self.url = url


def _ask(url: str, timeout: float, max_bytes: int) -> tuple:
    """What a target answers now; an answer that fails or is too long is an error and not half an answer."""
    now = dt.datetime.now(dt.timezone.utc)
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:
            body = answer.read(max_bytes + 1)
        if len(body) > max_bytes:
            raise ValueError(f"more than {max_bytes} bytes")
        return url, now, body.decode("utf-8"), None
    except Exception as e:  # a target that is down must not end the scrape of the others
        return url, now, None, f"{type(e).__name__}: {e}"


class _Settings:
    def __init__(self, options: dict[str, str]):
        self.targets = [t for t in options.get("targets", "").split() if t]
        self.timeout = float(options.get("timeout", TIMEOUT_SECONDS))
        self.interval = float(options.get("interval", SCRAPE_SECONDS))
        self.max_bytes = int(options.get("maxBytes", MAX_BYTES))
        if not self.targets:
            raise ValueError("option targets: addresses with spaces between them")


class _Reader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self._settings = settings

    def partitions(self) -> Sequence[InputPartition]:
        return [Target(url) for url in self._settings.targets]

    def read(self, partition: Target) -> Iterator[tuple]:
        yield _ask(partition.url, self._settings.timeout, self._settings.max_bytes)


class _StreamReader(_Reader, DataSourceStreamReader):
    """Every interval is an offset. Intervals that have passed unasked cannot be asked any more: a batch asks once."""

    def initialOffset(self) -> dict:
        return {"tick": int(time.time() // self._settings.interval) - 1}

    def latestOffset(self) -> dict:
        return {"tick": int(time.time() // self._settings.interval)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Target(url) for url in self._settings.targets] if end["tick"] > start["tick"] else []


class ScrapeSource(DataSource):
    """``spark.read.format("scrapes").option("targets", "http://a:8080/metrics http://b:8080/metrics")``.

    One task for each target; rows of ``target, scraped_at, body, error``. Other options: ``timeout`` and, for streams,
    ``interval`` in seconds, and ``maxBytes`` of an answer.
    """

    @classmethod
    def name(cls) -> str:
        return "scrapes"

    def schema(self) -> str:
        return _ANSWERS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Settings(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Settings(self.options))


def scrape(spark: SparkSession, targets: Sequence[str], stream: bool = False, **options: str) -> DataFrame:
    """What the targets answer now, or, as a stream, at every interval."""
    spark.dataSource.register(ScrapeSource)
    reader = spark.readStream if stream else spark.read
    return reader.format("scrapes").option("targets", " ".join(targets)).options(**options).load()


def answered_samples(answers: DataFrame) -> DataFrame:
    """``target, ts, metric, labels, value, error`` of all samples in the answers, and ``up`` of each target.

    Samples without a time of their own have that of the scrape.
    """
    up = F.struct(F.lit("up").alias("metric"), F.create_map().cast("map<string,string>").alias("labels"), F.col("error").isNull().cast("double").alias("value"), F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("string").alias("error"))
    lines = F.filter(F.split(F.coalesce("body", F.lit("")), "\n"), exposition.is_sample)
    found = F.concat(F.transform(lines, exposition.sample), F.array(up))
    rows = answers.select("target", "scraped_at", F.explode(found).alias("s"))
    return rows.select("target", F.coalesce("s.ts", "scraped_at").alias("ts"), "s.metric", "s.labels", "s.value", "s.error")


def scrape_folder(spark: SparkSession, path: str, target: str = "target", stream: bool = False) -> DataFrame:
    """Lines of scrapes kept below ``path``, in a folder for each target; a long file is split among tasks."""
    reader = (spark.readStream if stream else spark.read).schema(f"value string, {target} string")
    return reader.text(path)


def parsed_lines(lines: DataFrame, line: str = "value", keep: Sequence[str] = ("target",)) -> DataFrame:
    """``keep`` columns and ``metric, labels, value, ts, error`` of each sample line, batch or streaming."""
    samples = lines.filter(exposition.is_sample(F.col(line)))
    return samples.select(*keep, exposition.sample(F.col(line)).alias("_sample")).select(*keep, "_sample.*")


def described(lines: DataFrame, line: str = "value") -> DataFrame:
    """``metric, type, help`` of each metric that comments describe; the least of differing ones."""
    notes = lines.select(exposition.about(F.col(line)).alias("a")).filter("a is not null").select("a.*")
    pick = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("text")))
    return notes.groupBy("metric").agg(pick("TYPE").alias("type"), pick("HELP").alias("help"))

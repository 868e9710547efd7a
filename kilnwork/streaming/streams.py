"""Streaming forms of the metric, job and scoring operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kilnwork.functions import status as states
from kilnwork.operators import rollups
from kilnwork.session import ROCKSDB, STATE_STORE

WATERMARK = "10 minutes"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as they arrive below ``path``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def as_instant(ts: Column) -> Column:
    """A timestamp without zone, read as UTC; watermarks need the type with zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def windowed_metrics(
    samples: DataFrame, every: str = rollups.SCRAPE_INTERVAL, watermark: str = WATERMARK
) -> DataFrame:
    """Fixed windows over a stream; a window is final once the watermark has passed its end."""
    return rollups.tumbling(samples.withWatermark("ts", watermark), every)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, rocksdb: bool = False) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table until the input at hand is used up.

    ``rocksdb``: keep this stream's state in RocksDB, which state processors need, whatever the session's other streams use.
    """
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    if rocksdb:
        conf.set(STATE_STORE, ROCKSDB)
    try:  # a started query has settings of its own
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if rocksdb:
            conf.set(STATE_STORE, before)


def windows_left(
    samples: DataFrame, every: str = rollups.SCRAPE_INTERVAL, watermark: str = WATERMARK
) -> DataFrame:
    """The windows that :func:`windowed_metrics` has not given out when a finished input ends, from the input's table.

    They end within ``watermark`` before the last sample, or after it; only samples near the end are read again.
    """
    last = samples.agg(F.max("ts").alias("last")).first()["last"]
    if last is None:
        return rollups.tumbling(samples, every)
    mark = F.lit(last) - F.expr(f"interval {watermark}")
    near = samples.filter(F.col("ts") >= mark - F.expr(f"interval {every}"))
    return rollups.tumbling(near, every).filter(F.col("window.end") > mark)


def track_jobs(
    events: DataFrame,
    path: str,
    checkpoint: str,
    on_terminal: Callable[[DataFrame, int], None] | None = None,
    compact_every: int = 100,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Keep the last status of each job; jobs that have ended are handed to ``on_terminal``.

    The stream itself holds no state. Each trigger writes the last status of the jobs it saw into a folder of its own,
    which a repeated trigger overwrites. Every ``compact_every`` triggers the state of all jobs is written as one
    folder and the folders before the last but one such state are removed, so that neither reads nor folders grow
    with time. ``forget_after`` (such as ``"30 days"``) leaves jobs out of that state that ended so long before the
    newest event.
    """

    def write(arrived: DataFrame, batch_id: int) -> None:
        spark = arrived.sparkSession
        last = F.max(F.struct("ts", "seq", "status")).alias("last")
        seen = arrived.groupBy("job_id").agg(last).select("job_id", "last.status", "last.ts", "last.seq")
        folder = f"{path}/kind=change/batch={batch_id}"
        seen.write.mode("overwrite").parquet(folder)
        if on_terminal:
            ended = spark.read.parquet(folder).filter(states.is_terminal(F.col("status")))
            on_terminal(ended.select("job_id", "status", "ts"), batch_id)
        if (batch_id + 1) % compact_every == 0:
            state = _last_states(spark, path, before=batch_id)
            if forget_after:
                newest = state.agg(F.max("ts").alias("newest")).first()["newest"]
                old = F.col("ts") < F.lit(newest) - F.expr(f"interval {forget_after}")
                state = state.filter(~(states.is_terminal(F.col("status")) & old))
            state.write.mode("overwrite").parquet(f"{path}/kind=whole/batch={batch_id}")
            _remove_before(spark, path, batch_id - compact_every)

    return (
        events.select("job_id", "seq", "ts", "status")
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _remove_before(spark: SparkSession, path: str, batch: int) -> None:
    """Remove folders that the state of all jobs written at ``batch`` stands for. That state itself stays."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for kind, least in (("change", batch + 1), ("whole", batch)):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"kind={kind}")
        for found in store.listStatus(folder) if store.exists(folder) else ():
            number = found.getPath().getName().removeprefix("batch=")
            if number.isdigit() and int(number) < least:
                store.delete(found.getPath(), True)


def tracked_jobs(spark: SparkSession, path: str) -> DataFrame:
    """The last written status of each job: the last state of all jobs, and the changes after it."""
    return _last_states(spark, path).select("job_id", "status", "ts")


def _last_states(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    whole = rows.filter("kind = 'whole'")
    if before is not None:
        whole = whole.filter(F.col("batch") < before)
    base = whole.agg(F.max("batch")).first()[0]
    rows = rows.filter("kind = 'change'") if base is None else whole.filter(F.col("batch") == base).unionByName(
        rows.filter((F.col("kind") == "change") & (F.col("batch") > base))
    )
    last = F.max(F.struct("ts", "seq", "status")).alias("last")
    return rows.groupBy("job_id").agg(last).select("job_id", "last.status", "last.ts", "last.seq")

"""Ends of streams: a last row that lets event time pass whatever is still held."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from kilnwork.streaming import streams

#: Later than any sample: windows that end before it are final.
NEVER = dt.datetime(9000, 1, 1, tzinfo=dt.timezone.utc)


def with_endings(stream: DataFrame, folder: str, ts: str = "ts") -> DataFrame:
    """The stream, and the rows that :func:`end_stream` puts into ``folder``: a ``ts`` and NULL in all other columns."""
    spark = stream.sparkSession
    schema = stream.select(ts).schema
    spark.createDataFrame([], schema).write.mode("append").parquet(folder)
    ends = streams.file_stream(spark, folder, schema)
    return stream.unionByName(ends, allowMissingColumns=True)


def end_stream(spark: SparkSession, folder: str, at: dt.datetime = NEVER, kind: str = "timestamp", ts: str = "ts") -> None:
    """Say that nothing before ``at`` will come any more."""
    row = spark.range(1).select(F.lit(at).cast(kind).alias(ts))
    row.coalesce(1).write.mode("append").parquet(folder)


def run_to_end(
    start: Callable[[], StreamingQuery], spark: SparkSession, folder: str, at: Callable[[], dt.datetime | None] | None = None
) -> None:
    """Use up the input at hand, end the stream, and let the same query give out what it still holds.

    ``start`` starts the query from its checkpoint, with :func:`with_endings` of ``folder`` as its input. ``at`` says after
    the first run when the stream ended, if not :data:`NEVER`; None if it had no rows.
    """
    start().awaitTermination()
    moment = NEVER if at is None else at()
    if moment is not None:
        end_stream(spark, folder, moment)
        start().awaitTermination()

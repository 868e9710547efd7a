"""Batch functions over Arrow: the one way Python code runs on rows here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType


def map_batches(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: StructType | str,
    batch_size: int | None = None,
) -> DataFrame:
    """Apply a stateless function to every batch."""
    return map_batches_with(df, lambda: fn, schema, batch_size)


def map_batches_with(
    df: DataFrame,
    build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: StructType | str,
    batch_size: int | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Apply a batch function that is built once per task, such as one holding a model.

    Tasks are the partitions of ``df``; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fn = fn or build()
            step = batch_size or batch.num_rows
            for start in range(0, batch.num_rows, step):
                yield fn(batch.slice(start, step))

    return df.mapInArrow(run, schema, profile=profile)


def fanout(
    df: DataFrame, fn: Callable[..., object], *args: str, column: str = "result", kind: str = "string"
) -> DataFrame:
    """Call a function once for each row, spread over the tasks, with the values of columns ``args``.

    ``kind`` is the type of its results. For work that is long for each call; what a column expression
    or a batch function can say is faster there.
    """
    names = df.schema.names

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(name).to_pylist() for name in args]
            results = [fn(*values) for values in (zip(*given, strict=True) if given else [()] * batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(results, wanted)], [*names, column])

    schema = StructType([*df.schema.fields, *StructType.fromDDL(f"`{column}` {kind}").fields])
    wanted = to_arrow_type(schema[column].dataType)
    return df.mapInArrow(call, schema)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores where the input has fewer partitions than that.

    Worth its shuffle only before expensive work on rows, such as a network on
    images: a file that cannot be split would keep all its rows in one task.
    A large input has enough partitions and is left alone.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def gpu_profile(num_gpus: float) -> ResourceProfile | None:
    """Stage-level request for GPUs; none for 0."""
    if num_gpus <= 0:
        return None
    executor = ExecutorResourceRequests().resource("gpu", max(1, int(np.ceil(num_gpus))))
    task = TaskResourceRequests().cpus(1).resource("gpu", num_gpus)
    return ResourceProfileBuilder().require(executor).require(task).build


def vectors(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A list column as ``[n, width]`` and a mask of the rows that are usable.

    Rows that are NULL, have another length, or hold a NULL, NaN or infinity are left at zero.
    """
    n = len(column)
    lengths = pc.list_value_length(column)
    if width is None:
        width = int(pc.max(lengths).as_py() or 0)
    fits = pc.fill_null(pc.equal(lengths, width), False).to_numpy(zero_copy_only=False)
    kept = column if fits.all() else column.filter(pa.array(fits))
    # Integers with gaps come as floats with NaN.
    values = kept.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    finite = np.isfinite(values).all(axis=1)
    if fits.all() and finite.all():
        return values, fits
    usable = fits.copy()
    usable[fits] = finite
    dense = np.zeros((n, width), dtype=values.dtype)
    dense[usable] = values[finite]
    return dense, usable

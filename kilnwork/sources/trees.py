"""Listing and reading of large file trees by tasks.

Spark's own file sources list a tree on the driver, which holds every file's status. Here each task lists some folders,
one level of the tree after the other, and what is found stays a table. Small files are packed into splits by bytes, so
that the number of tasks that read them follows the bytes and not the files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.session import materialise

SPLIT_BYTES = 128 << 20
# A value of an Arrow column cannot be larger.
MAX_FILE_BYTES = (1 << 31) - 1

_FOUND = "key string, path string, size bigint, modified timestamp, folder boolean, error string"
_FOUND_SCHEMA = pa.schema(
    [("key", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("folder", pa.bool_()), ("error", pa.string())]
)


def _store(uri: str):
    """The file system of an address, the path there, and what its paths begin with as addresses."""
    from pyarrow import fs

    if not re.match(r"[a-z][a-z0-9+.-]*:", uri):
        uri = f"file:{uri}"
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri), "file:"
    scheme = uri.split(":")[0]
    store, path = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))
    # Paths in HDFS begin with a slash, after the host; those in object stores with the bucket.
    return store, path, uri.removesuffix(path) if path.startswith("/") else f"{scheme}://"


def _hidden(name: str) -> bool:
    """Names that Spark's sources leave out as well."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def list_tree(spark: SparkSession, uri: str, folders_per_task: int = 64) -> DataFrame:
    """``key, size, modified, error`` of every file below ``uri``; a folder that cannot be listed is a row with ``error``.

    The files are those of :func:`~kilnwork.sources.files.inventory`, with the same keys, and empty ones besides. The address must be one that
    Arrow's file systems reach from the tasks (local or shared folders, S3, HDFS, Google storage); links to folders are
    followed. One job for each level of the tree; a task holds the names of one folder at a time.
    """
    store, root, before = _store(uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store = _store(uri)[0]
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                try:
                    inside = store.get_file_info(fs.FileSelector(folder))
                except Exception as e:
                    row = {"key": before + folder, "path": folder, "folder": False, "error": f"{type(e).__name__}: {e}"}
                    yield pa.RecordBatch.from_pylist([row], _FOUND_SCHEMA)
                    continue
                for at in range(0, len(inside), 4096):
                    rows = [
                        {"key": before + i.path, "path": i.path, "size": None if i.size is None else int(i.size), "modified": None if i.mtime_ns is None else i.mtime_ns // 1_000_000 * 1000, "folder": i.type == fs.FileType.Directory, "error": None}
                        for i in inside[at : at + 4096]
                        if not _hidden(i.base_name)
                    ]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _FOUND_SCHEMA)

    level, levels = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string"), []
    width = 1
    while width:
        found = materialise(level.repartition(max(1, -(-width // folders_per_task))).mapInArrow(run, _FOUND), "listing")
        levels.append(found.filter("not folder"))
        level = found.filter("folder").select("path")
        width = level.count()
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    return every.select("key", "size", "modified", "error")


def packed(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The ``key, size`` rows with ``split``: files next to each other by key, as many as fit ``split_bytes``, at least one.

    Keys are sorted over all tasks, and each task packs its stretch of them.
    """
    rows = files.repartitionByRange("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, split, room = TaskContext.get().partitionId() << 40, -1, 0
        for batch in batches:
            splits = []
            for size in batch.column("size").to_pylist():
                if split < 0 or (size or 0) > room:
                    split, room = split + 1, split_bytes
                room -= size or 0
                splits.append(part + split)
            yield batch.append_column("split", pa.array(splits, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return rows.mapInArrow(run, f"{fields}, split bigint")


def read_packed(files: DataFrame, uri: str) -> DataFrame:
    """``key, split, bytes, error`` of the files of :func:`packed` below ``uri``; those of a split are read by one task."""
    before = _store(uri)[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _store(uri)[0]
        for batch in batches:
            for key, size, split in zip(*(batch.column(c).to_pylist() for c in ("key", "size", "split")), strict=True):
                body = error = None
                try:
                    if (size or 0) > MAX_FILE_BYTES:
                        raise ValueError(f"more than {MAX_FILE_BYTES} bytes")
                    with store.open_input_stream(key.removeprefix(before)) as file:
                        body = file.read()
                except Exception as e:  # one unreadable file must not end the others
                    error = f"{type(e).__name__}: {e}"
                columns = [pa.array([key], pa.string()), pa.array([split], pa.int64()), pa.array([body], pa.binary()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "split", "bytes", "error"])

    chosen = files.filter("size is not null").select("key", "size", "split")
    return chosen.repartition("split").mapInArrow(run, "key string, split bigint, bytes binary, error string")

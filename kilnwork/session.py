"""Session defaults and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows differ a lot in width (64 floats or a whole image), so cap Arrow
    # batches by bytes as well as by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # Keeps the state of streams off the JVM heap.
    STATE_STORE: ROCKSDB,
}


def build_session(app_name: str = "kilnwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application.

    Needed where it is neither installed on the executors nor passed with ``--py-files``.
    The archive is made next to the driver, and Spark hands it to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_kilnwork_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="kilnwork-"), "kilnwork.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    # Streams with state processors also start a worker on the driver, which does not get the added files.
    paths = (context.environment.get("PYTHONPATH"), archive)
    context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, paths))
    context._kilnwork_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables, in the folder the cluster shares.

    The folder is ``spark.checkpoint.dir``. It is set here only for local
    masters that leave it unset; elsewhere a machine-local folder would not be
    visible to the other executors, so an unset folder is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="kilnwork-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several passes read to shared scratch space and read it back.

    Unlike a cache, the files outlive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

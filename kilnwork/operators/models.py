"""Classifiers that scoring tasks load once, and the registry that names them.

A model is any object with ``logits(batch) -> [n, classes]``. A loader is a
callable without arguments that returns one; it runs inside the task, so what
it closes over must be small or a broadcast.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from typing import Protocol

import numpy as np
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.sources import files

# A model above this size is not broadcast: linear weights are cut into blocks of
# classes (``weight_blocks``), and model files are fetched once per executor.
MAX_BROADCAST_BYTES = 256 << 20
_OVERHEAD_BYTES = 64 << 10  # names and small parts of a model, besides its weights

# The named image classifiers a caller may ask for.
IMAGE_MODELS = ("resnet18", "resnet34", "resnet50", "resnet101")


class Model(Protocol):
    def logits(self, batch: np.ndarray) -> np.ndarray: ...


Loader = Callable[[], Model]


@dataclass(frozen=True)
class LinearModel:
    """``x W^T + b`` with ``weights`` of shape [classes, features].

    ``class_ids`` names the classes in ascending order where they are not 0, 1, 2 and so on.
    """

    weights: np.ndarray
    bias: np.ndarray
    class_ids: np.ndarray | None = None

    def logits(self, batch: np.ndarray) -> np.ndarray:
        return batch.reshape(len(batch), -1).astype(np.float64, copy=False) @ self.weights.T + self.bias


@dataclass(frozen=True)
class ConvModel:
    """3x3 convolution, 3x3 max-pooling, relu, one linear layer.

    On 28x28 inputs with 3 filters and 10 classes it has 1,960 parameters.
    """

    kernels: np.ndarray  # [filters, 3, 3]
    kernel_bias: np.ndarray  # [filters]
    weights: np.ndarray  # [classes, filters * pooled * pooled]
    bias: np.ndarray  # [classes]

    @classmethod
    def from_flat(cls, flat: np.ndarray, side: int = 28, filters: int = 3, classes: int = 10) -> ConvModel:
        hidden = filters * ((side - 2) // 3) ** 2
        sizes = np.cumsum([filters * 9, filters, classes * hidden])
        kernels, kernel_bias, weights, bias = np.split(np.asarray(flat, dtype=np.float64), sizes)
        return cls(kernels.reshape(filters, 3, 3), kernel_bias, weights.reshape(classes, hidden), bias)

    def logits(self, batch: np.ndarray) -> np.ndarray:
        n = len(batch)
        side = batch.shape[-1] if batch.ndim > 2 else round(batch.shape[1] ** 0.5)
        windows = np.lib.stride_tricks.sliding_window_view(batch.reshape(n, side, side), (3, 3), axis=(1, 2))
        maps = np.einsum("nijkl,fkl->nfij", windows, self.kernels, optimize=True)
        maps += self.kernel_bias[:, None, None]
        pooled = maps.shape[-1] // 3
        maps = maps[:, :, : pooled * 3, : pooled * 3].reshape(n, len(self.kernels), pooled, 3, pooled, 3)
        hidden = np.maximum(maps.max(axis=(3, 5)), 0.0).reshape(n, -1)
        return hidden @ self.weights.T + self.bias


class OnnxModel:
    """An exported network, run by onnxruntime on the executor."""

    def __init__(self, source: bytes | str):
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = 1  # parallelism comes from Spark tasks
        self._session = onnxruntime.InferenceSession(
            source, options, providers=onnxruntime.get_available_providers()
        )
        self._input = self._session.get_inputs()[0].name

    def logits(self, batch: np.ndarray) -> np.ndarray:
        return self._session.run(None, {self._input: batch.astype(np.float32, copy=False)})[0]


class ModelRegistry:
    """Named loaders. Names are checked on the driver, before any job starts."""

    def __init__(self, declared: tuple[str, ...] = IMAGE_MODELS):
        self._declared = declared
        self._loaders: dict[str, Loader] = {}

    def register(self, name: str, loader: Loader) -> None:
        self._loaders[name] = loader

    def loader(self, name: str) -> Loader:
        if name in self._loaders:
            return self._loaders[name]
        if name in self._declared:
            raise ValueError(f"no weights registered for model: {name}")
        raise ValueError(f"{name!r} is none of the declared models")


def broadcast_loader(spark: SparkSession, model: Model) -> Loader:
    """Ship a model to the executors once each."""
    # What is really sent, whatever the model keeps its weights in.
    size = len(cloudpickle.dumps(model))
    if size > MAX_BROADCAST_BYTES + _OVERHEAD_BYTES:
        raise ValueError(f"a model of {size} bytes is too large to broadcast")
    shared = spark.sparkContext.broadcast(model)
    return lambda: shared.value


def onnx_loader(spark: SparkSession, path: str, store: dict[str, str] | None = None) -> Loader:
    """Loader for a model file on any file system Spark reads, with settings for its store if it needs any."""
    found = files.scan_files(spark, path, store)
    size = found.agg(F.max("length")).first()[0]
    if size <= MAX_BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast(bytes(found.select("content").first()[0]))
        return lambda: OnnxModel(shared.value)
    # Read with the settings of the store, then handed out by Spark's file server, once for each executor.
    folder = tempfile.mkdtemp(prefix="kilnwork-model-")
    name = f"{uuid.uuid4().hex}.onnx"
    with open(os.path.join(folder, name), "wb") as out:
        out.write(found.select("content").first()[0])
    spark.sparkContext.addFile(os.path.join(folder, name))
    return lambda: OnnxModel(SparkFiles.get(name))


@contextlib.contextmanager
def broadcast_limit(size: int) -> Iterator[None]:
    """Another limit for weights that are gathered meanwhile, for clusters with small drivers."""
    global MAX_BROADCAST_BYTES
    before, MAX_BROADCAST_BYTES = MAX_BROADCAST_BYTES, size
    try:
        yield
    finally:
        MAX_BROADCAST_BYTES = before


def weight_blocks(weights: DataFrame) -> Iterator[LinearModel]:
    """A ``class_id, pos, weight`` table as models of some classes each, whose cells fit a broadcast.

    Position -1 holds the bias of a class. All blocks have the same width. Only one block is on the driver at a time.
    """
    shape = weights.agg(F.max("pos").alias("pos"), F.count(F.lit(1)).alias("cells")).first()
    if not shape["cells"]:
        raise ValueError("the weight table is empty")
    width = max(shape["pos"], -1) + 1
    size = MAX_BROADCAST_BYTES // (8 * (width + 1))
    if size < 1:
        raise ValueError("the weights of one class are too large to broadcast")
    known = weights.select("class_id").filter("class_id is not null").distinct()
    last = None
    while True:
        ahead = known if last is None else known.filter(F.col("class_id") > last)
        ids = [r["class_id"] for r in ahead.orderBy("class_id").limit(size).collect()]
        if not ids:
            return
        last = ids[-1]
        part = weights.filter(F.col("class_id").between(ids[0], last))
        # A cell that is there twice counts with its sum, so there are no more rows than cells.
        cells = part.groupBy("class_id", "pos").agg(F.sum("weight").alias("weight")).toArrow()
        index = np.searchsorted(np.array(ids), cells.column("class_id").to_numpy())
        pos, values = cells.column("pos").to_numpy(), cells.column("weight").to_numpy()
        matrix, bias = np.zeros((len(ids), width)), np.zeros(len(ids))
        entry = pos >= 0
        matrix[index[entry], pos[entry]] = values[entry]
        bias[index[~entry]] = values[~entry]
        yield LinearModel(matrix, bias, np.array(ids))


def linear_model(weights: DataFrame) -> LinearModel:
    """All classes of a ``class_id, pos, weight`` table as one model."""
    blocks = weight_blocks(weights)
    model = next(blocks)
    if next(blocks, None) is not None:
        raise ValueError("weights are too large for one model; use scoring.score_linear")
    if np.array_equal(model.class_ids, np.arange(len(model.class_ids))):
        return replace(model, class_ids=None)
    return model

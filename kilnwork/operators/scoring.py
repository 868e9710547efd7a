"""Batch inference: features in, class probabilities and top classes out."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, functions as F, types as T

from kilnwork.operators import batches, models
from kilnwork.session import materialise

TOP_K = 5
ON_ERROR = ("zero", "null", "fail")

_RESULT_FIELDS = [
    T.StructField("predicted_class", T.IntegerType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("top_5_classes", T.ArrayType(T.IntegerType())),
    T.StructField("top_5_scores", T.ArrayType(T.DoubleType())),
    T.StructField("file_path", T.StringType()),
    T.StructField("error", T.StringType()),
]

# Turns a batch into model input [n, ...] and one error message (or None) per
# row. Rows with a message must be left at zero.
Featuriser = Callable[[pa.RecordBatch], tuple[np.ndarray, list[str | None]]]


def vector_features(column: str, width: int | None = None) -> Featuriser:
    """Read model input from an array column."""

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str | None]]:
        values, usable = batches.vectors(batch.column(column), width)
        if usable.all():
            return values, [None] * batch.num_rows
        return values, [None if ok else f"unusable features in {column}" for ok in usable]

    return read


def probabilities(logits: np.ndarray) -> np.ndarray:
    logits = np.asarray(logits, dtype=np.float64)
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _infer(
    batch: pa.RecordBatch,
    ready: dict[str, models.Model],
    featurise: Featuriser,
    batch_size: int,
    on_error: str,
) -> tuple[dict[str, np.ndarray], list[str | None]]:
    """Probabilities by each model, from features that are prepared once for all, and the errors of the rows."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name in ready}
    errors: list[str | None] = []
    for start in range(0, batch.num_rows, batch_size):
        inputs, messages = featurise(batch.slice(start, batch_size))
        failed = next((m for m in messages if m), None)
        if failed and on_error == "fail":
            raise ValueError(failed)
        errors.extend(messages)
        for name, model in ready.items():
            parts[name].append(probabilities(model.logits(inputs)))
    return {name: np.concatenate(found) for name, found in parts.items()}, errors


def _ranked(probs: np.ndarray, class_ids: np.ndarray | None, lost: np.ndarray | None) -> list[pa.Array]:
    """Best class and score, and the top classes and scores; NULL where ``lost``."""
    n, k = len(probs), min(TOP_K, probs.shape[1])
    # A stable sort of the negated scores puts the lowest class first on a tie.
    top = np.argsort(-probs, axis=1, kind="stable")[:, :k]
    scores = np.take_along_axis(probs, top, axis=1)
    if class_ids is not None:
        top = class_ids[top]
    top = top.astype(np.int32)
    offsets = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
    gaps = None if lost is None else pa.array(lost)
    return [
        pa.array(top[:, 0], mask=lost),
        pa.array(scores[:, 0], mask=lost),
        pa.ListArray.from_arrays(offsets, pa.array(top.ravel()), mask=gaps),
        pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()), mask=gaps),
    ]


def score(
    df: DataFrame,
    loader: models.Loader,
    featurise: Featuriser,
    *,
    path: str | None = "path",
    keep: Sequence[str] = (),
    batch_size: int = 32,
    on_error: str = "zero",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Score every row. See :func:`score_variants` for the parameters."""
    scored = score_variants(
        df,
        {"": loader},
        featurise,
        path=path,
        keep=keep,
        batch_size=batch_size,
        on_error=on_error,
        profile=profile,
    )
    return scored.drop("model_name")


def score_variants(
    df: DataFrame,
    loaders: dict[str, models.Loader],
    featurise: Featuriser,
    *,
    path: str | None = "path",
    keep: Sequence[str] = (),
    batch_size: int = 32,
    on_error: str = "zero",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Score every row with each named model, in one pass over the rows.

    ``path`` names the column reported as ``file_path`` (NULL if it is absent);
    ``keep`` columns are carried through, which saves a join with targets later.
    Rows whose features cannot be read are scored as zeros with a message in
    ``error`` (``on_error="zero"``), get NULL results (``"null"``) or end the
    job (``"fail"``). Select the columns the scorer needs and filter before
    calling: Spark does not move either through a Python stage.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    keep = list(keep)
    has_path = path is not None and path in df.columns
    schema = T.StructType(
        [df.schema[name] for name in keep] + _RESULT_FIELDS + [T.StructField("model_name", T.StringType())]
    )

    def build() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        ready = {name: load() for name, load in loaders.items()}

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept = [batch.column(name) for name in keep]
            paths = batch.column(path) if has_path else pa.nulls(batch.num_rows, pa.string())
            found, messages = _infer(batch, ready, featurise, batch_size, on_error)
            errors = pa.array(messages, pa.string())
            lost = np.array([m is not None for m in messages]) if on_error == "null" else None
            outputs = []
            for name, probs in found.items():
                results = _ranked(probs, getattr(ready[name], "class_ids", None), lost)
                label = pa.array([name] * batch.num_rows, pa.string())
                outputs.append(
                    pa.RecordBatch.from_arrays([*kept, *results, paths, errors, label], names=schema.names)
                )
            if len(outputs) == 1:
                return outputs[0]
            return pa.Table.from_batches(outputs).combine_chunks().to_batches()[0]

        return run

    return batches.map_batches_with(df, build, schema, profile=profile)


def score_logits(
    df: DataFrame, loader: models.Loader, featurise: Featuriser, *, keep: Sequence[str] = (), batch_size: int = 4096
) -> DataFrame:
    """The ``keep`` columns and the raw ``logits`` of each row, for losses; unusable rows get NULL."""
    keep = list(keep)
    schema = T.StructType([df.schema[name] for name in keep] + [T.StructField("logits", T.ArrayType(T.DoubleType()))])

    def build() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = loader()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            inputs, errors = featurise(batch)
            logits = np.ascontiguousarray(model.logits(inputs), dtype=np.float64)
            ids = getattr(model, "class_ids", None)
            if ids is not None:  # classes the model does not know are impossible
                known, logits = logits, np.full((len(logits), ids.max() + 1), -np.inf)
                logits[:, ids] = known
            offsets = pa.array(np.arange(0, logits.size + 1, logits.shape[1], dtype=np.int32))
            lost = pa.array([m is not None for m in errors])
            lists = pa.ListArray.from_arrays(offsets, pa.array(logits.ravel()), mask=lost)
            return pa.RecordBatch.from_arrays([*[batch.column(name) for name in keep], lists], names=schema.names)

        return run

    return batches.map_batches_with(df, build, schema, batch_size)


def score_linear(
    df: DataFrame,
    weights: DataFrame,
    *,
    features: str,
    path: str | None = "path",
    keep: Sequence[str] = (),
    batch_size: int = 4096,
    on_error: str = "zero",
) -> DataFrame:
    """Score with a ``class_id, pos, weight`` table of any size; returns the columns of :func:`score` after ``keep``.

    Weights that fit one broadcast take one pass over the rows. Larger ones are cut into blocks of classes; each block
    passes over the rows in a job of its own and adds to what a row carries: its best logits so far, and the sum for its
    softmax. No row is moved or needs a key, so repeated and NULL values are scored alike at every size.
    """
    blocks = models.weight_blocks(weights)
    first, second = next(blocks), next(blocks, None)
    spark = df.sparkSession
    if second is None:
        loader = models.broadcast_loader(spark, first)
        featurise = vector_features(features, first.weights.shape[1])
        return score(df, loader, featurise, path=path, keep=keep, batch_size=batch_size, on_error=on_error)
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    has_path = path is not None and path in df.columns
    carried = df.select(
        F.struct(*keep).alias("kept") if keep else F.struct(F.lit(0)).alias("kept"),
        (F.col(path) if has_path else F.lit(None)).cast("string").alias("file_path"),
        F.col(features).alias("x"),
        F.array().cast("array<int>").alias("ids"),
        F.array().cast("array<double>").alias("logits"),
        F.lit(-math.inf).alias("peak"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast("string").alias("error"),
    )
    for block in itertools.chain([first, second], blocks):
        # Written after every block: only one block of weights is in memory at a time.
        carried = materialise(_add_block(carried, block, features, batch_size, on_error), "scores")
    lost = F.col("error").isNotNull() if on_error == "null" else F.lit(False)
    ids, scores = F.col("ids"), F.transform("logits", lambda v: F.exp(v - F.col("peak")) / F.col("total"))
    return carried.select(
        *(F.col("kept")[name].alias(name) for name in keep),
        F.when(~lost, F.get(ids, F.lit(0))).alias("predicted_class"),
        F.when(~lost, F.get(scores, F.lit(0))).alias("confidence_score"),
        F.when(~lost, ids).alias("top_5_classes"),
        F.when(~lost, scores).alias("top_5_scores"),
        "file_path",
        "error",
    )


def _add_block(rows: DataFrame, block: models.LinearModel, features: str, batch_size: int, on_error: str) -> DataFrame:
    loader = models.broadcast_loader(rows.sparkSession, block)
    width = block.weights.shape[1]

    def build() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = loader()
        read = vector_features("x", width)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            inputs, messages = read(batch)
            named = [m and f"unusable features in {features}" for m in messages]
            if on_error == "fail" and any(named):
                raise ValueError(next(filter(None, named)))
            logits = model.logits(inputs)
            peak, total = batch.column("peak").to_numpy(), batch.column("total").to_numpy()
            new = np.maximum(peak, logits.max(axis=1))
            total = total * np.exp(peak - new) + np.exp(logits - new[:, None]).sum(axis=1)
            # Earlier blocks hold lower classes, so a stable sort keeps the lowest class first on a tie.
            seen = batch.column("logits").flatten().to_numpy().reshape(len(logits), -1)
            ids = batch.column("ids").flatten().to_numpy().reshape(len(logits), -1)
            every = np.concatenate([seen, logits], axis=1)
            classes = np.concatenate([ids, np.broadcast_to(model.class_ids, logits.shape)], axis=1)
            top = np.argsort(-every, axis=1, kind="stable")[:, :TOP_K]
            offsets = pa.array(np.arange(len(logits) + 1, dtype=np.int32) * top.shape[1])
            columns = {
                "ids": pa.ListArray.from_arrays(offsets, pa.array(np.take_along_axis(classes, top, 1).ravel().astype(np.int32))),
                "logits": pa.ListArray.from_arrays(offsets, pa.array(np.take_along_axis(every, top, 1).ravel())),
                "peak": pa.array(new),
                "total": pa.array(total),
                "error": pa.array(named, pa.string()),
            }
            names = batch.schema.names
            return pa.RecordBatch.from_arrays([columns.get(n, batch.column(n)) for n in names], names)

        return run

    return batches.map_batches_with(rows, build, rows.schema, batch_size)


def class_means(df: DataFrame, features: str, label: str) -> DataFrame:
    """Mean vector of each label as ``class_id, pos, weight``, the simplest linear model.

    Partial sums are formed before the shuffle, which then moves one row per
    label and position from each task.
    """
    labelled = df.filter(F.col(label).isNotNull())
    cells = labelled.select(F.col(label).alias("class_id"), F.posexplode(features).alias("pos", "x"))
    return cells.groupBy("class_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("weight"))

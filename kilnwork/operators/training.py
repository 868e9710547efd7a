"""Distributed gradient passes that advance many trials at once.

The samples stay partitioned; the driver holds one parameter vector per trial.
A pass broadcasts the parameters, sums gradients within each task, and adds the
per-task sums up by a shuffle. All trials share the pass, so fifty trials read
the samples once, not fifty times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from kilnwork.operators import batches
from kilnwork.operators.models import MAX_BROADCAST_BYTES, ConvModel

# Doubles in one intermediate array: bounds the memory of a task and stays near the caches.
_WORK_CELLS = 1 << 20
# Groups of tasks whose sums are added first.
FAN_IN = 64


class Trainable(Protocol):
    """What a search trains: ``params`` is [trials, n_params], ``x`` is [rows, ...], ``y`` is [rows]."""

    n_params: int

    def initial(self, trial_ids: np.ndarray) -> np.ndarray: ...

    def gradient(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the rows: gradients [trials, n_params] and losses [trials]."""

    def correct(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rows predicted right, [trials]."""


@dataclass(frozen=True)
class SoftmaxRegression:
    """A linear classifier trained on the negative log-likelihood; the bias is the last feature.

    Weights start at zero, or, with ``start``, at draws by hash within that distance of zero, other ones for each trial.
    """

    width: int
    classes: int
    start: float = 0.0

    @property
    def n_params(self) -> int:
        return (self.width + 1) * self.classes

    def initial(self, trial_ids: np.ndarray) -> np.ndarray:
        if not self.start:
            return np.zeros((len(trial_ids), self.n_params))
        seeds = [[f"start-{t}-{i}".encode() for i in range(self.n_params)] for t in np.asarray(trial_ids).tolist()]
        draws = [[int(hashlib.md5(s, usedforsecurity=False).hexdigest()[:8], 16) / 2**32 for s in row] for row in seeds]
        return self.start * (2 * np.array(draws).reshape(len(seeds), self.n_params) - 1)

    def _logits(self, params: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        trials = len(params)
        inputs = np.column_stack([x.reshape(len(x), -1), np.ones(len(x))]).astype(np.float64, copy=False)
        # One product for all trials: [rows, width + 1] x [width + 1, trials * classes].
        stacked = params.reshape(trials, self.width + 1, self.classes).transpose(1, 0, 2)
        logits = inputs @ stacked.reshape(self.width + 1, trials * self.classes)
        return inputs, logits.reshape(len(x), trials, self.classes)

    def gradient(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inputs, logits = self._logits(params, x)
        rows = np.arange(len(x))
        logits -= logits.max(axis=2, keepdims=True)
        powers = np.exp(logits)
        totals = powers.sum(axis=2)
        losses = (np.log(totals) - logits[rows, :, y]).sum(axis=0)
        residual = powers / totals[:, :, None]
        residual[rows, :, y] -= 1.0
        grads = inputs.T @ residual.reshape(len(x), -1)
        grads = grads.reshape(self.width + 1, len(params), self.classes).transpose(1, 0, 2)
        return grads.reshape(len(params), -1), losses

    def correct(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        _, logits = self._logits(params, x)
        return (logits.argmax(axis=2) == y[:, None]).sum(axis=0)


@dataclass(frozen=True)
class ConvClassifier:
    """The small convolutional network of :class:`ConvModel` on square one-channel inputs."""

    side: int = 28
    filters: int = 3
    classes: int = 10

    @property
    def _pooled(self) -> int:
        return (self.side - 2) // 3

    @property
    def n_params(self) -> int:
        return self.filters * 10 + self.classes * (self.filters * self._pooled**2 + 1)

    def initial(self, trial_ids: np.ndarray) -> np.ndarray:
        """Uniform within one over the root of the fan-in, seeded by the trial."""
        hidden = self.filters * self._pooled**2
        bound = np.concatenate(
            [
                np.full(self.filters * 10, 1 / 3),
                np.full(self.classes * (hidden + 1), 1 / np.sqrt(hidden)),
            ]
        )
        draws = [np.random.default_rng(int(t)).uniform(-1, 1, self.n_params) for t in trial_ids]
        return np.array(draws).reshape(len(trial_ids), self.n_params) * bound

    def model(self, params: np.ndarray) -> ConvModel:
        return ConvModel.from_flat(params, self.side, self.filters, self.classes)

    def correct(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.array([(self.model(p).logits(x).argmax(axis=1) == y).sum() for p in params])

    def gradient(self, params: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        results = [self._gradient(self.model(p), x, y) for p in params]
        return np.array([g for g, _ in results]), np.array([loss for _, loss in results])

    def _gradient(self, net: ConvModel, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        n, f, p = len(x), self.filters, self._pooled
        images = x.reshape(n, self.side, self.side)
        windows = np.lib.stride_tricks.sliding_window_view(images, (3, 3), axis=(1, 2))[:, : 3 * p, : 3 * p]
        maps = np.einsum("nijkl,fkl->nfij", windows, net.kernels, optimize=True) + net.kernel_bias[:, None, None]
        cells = maps.reshape(n, f, p, 3, p, 3).transpose(0, 1, 2, 4, 3, 5).reshape(n, f, p, p, 9)
        winner = cells.argmax(axis=4)[..., None]
        peak = np.take_along_axis(cells, winner, axis=4)[..., 0]
        hidden = np.maximum(peak, 0.0).reshape(n, -1)
        logits = hidden @ net.weights.T + net.bias
        logits -= logits.max(axis=1, keepdims=True)
        powers = np.exp(logits)
        totals = powers.sum(axis=1)
        loss = float((np.log(totals) - logits[np.arange(n), y]).sum())
        residual = powers / totals[:, None]
        residual[np.arange(n), y] -= 1.0
        # Back through the pooling: only the winning cell of each pool moves the kernel.
        back = (residual @ net.weights).reshape(n, f, p, p) * (peak > 0)
        spread = np.zeros_like(cells)
        np.put_along_axis(spread, winner, back[..., None], axis=4)
        spread = spread.reshape(n, f, p, p, 3, 3).transpose(0, 1, 2, 4, 3, 5).reshape(n, f, 3 * p, 3 * p)
        kernels = np.einsum("nfij,nijkl->fkl", spread, windows, optimize=True)
        parts = [kernels.ravel(), spread.sum(axis=(0, 2, 3)), (residual.T @ hidden).ravel(), residual.sum(axis=0)]
        return np.concatenate(parts), loss


@dataclass(frozen=True)
class PassResult:
    """Sums over all rows, one entry per trial."""

    gradient: np.ndarray
    loss: np.ndarray
    train_rows: int
    correct: np.ndarray
    test_rows: int


def partial_sums(
    df: DataFrame,
    trainable: Trainable,
    params: Broadcast[np.ndarray],
    features: str,
    label: str,
    is_test: str = "is_test",
    max_tasks: int | None = None,
) -> DataFrame:
    """``trial, pos, value``: gradients, then loss, training rows, correct and test rows, summed over all rows.

    Each task emits one row per trial; the shuffle moves those and not the samples. Rows stay whole arrays and are
    added in two steps: those of some tasks each in :data:`FAN_IN` groups, then the groups' sums. Only the last step
    takes them apart, so that the number of cells does not grow with the number of input splits.
    ``max_tasks`` lets a task read several input splits one after the other.
    """
    width, classes = feature_width(trainable), getattr(trainable, "classes", None)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = params.value
        trials = len(weights)
        totals = np.zeros((trials, trainable.n_params + 4))
        step = rows_at_a_time(trials, trainable.n_params)
        for batch in stream:
            for start in range(0, batch.num_rows, step):
                _add(totals, batch.slice(start, step), weights)
        values = pa.array(totals.ravel())
        offsets = pa.array(np.arange(0, totals.size + 1, totals.shape[1], dtype=np.int32))
        part = np.full(trials, TaskContext.get().partitionId() % FAN_IN, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(trials, dtype=np.int32)), pa.array(part), pa.ListArray.from_arrays(offsets, values)],
            names=["trial", "part", "sums"],
        )

    def _add(totals: np.ndarray, batch: pa.RecordBatch, weights: np.ndarray) -> None:
        x, usable = batches.vectors(batch.column(0), width)
        if not usable.all():
            raise ValueError(f"unusable features in {features}")
        y = class_labels(batch.column(1), classes, label)
        test = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        totals[:, -3] += (~test).sum()
        totals[:, -1] += test.sum()
        try:
            totals[:, :-3], totals[:, -2] = totals[:, :-3] + _fitted(weights, x[~test], y[~test]), totals[:, -2] + _right(weights, x[test], y[test])
        except Exception:  # a failing trial must not end the others: each by itself, and NaN for those that fail
            for t in range(len(weights)):
                one = weights[t : t + 1]
                try:
                    totals[t, :-3] += _fitted(one, x[~test], y[~test])[0]
                    totals[t, -2] += _right(one, x[test], y[test])[0]
                except Exception:
                    totals[t, :-3] = totals[t, -2] = np.nan

    def _fitted(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradients, and losses behind them."""
        if not len(x):
            return np.zeros((len(weights), trainable.n_params + 1))
        grads, losses = trainable.gradient(weights, x, y)
        return np.column_stack([grads, losses])

    def _right(weights: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return trainable.correct(weights, x, y) if len(x) else np.zeros(len(weights))

    rows = df.select(features, label, is_test)
    rows = rows.coalesce(max_tasks) if max_tasks else rows
    schema = "trial int, part int, sums array<double>"
    partial = rows.mapInArrow(run, schema)
    summed = partial.groupBy("trial", "part").applyInArrow(_added, schema)
    cells = summed.select("trial", F.posexplode("sums").alias("pos", "value"))
    return cells.groupBy("trial", "pos").agg(F.sum("value").alias("value"))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the sum of the rows' arrays, batch by batch."""
    total, first = 0.0, None
    for batch in batches:
        first = first or batch.slice(0, 1)
        total = total + batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
    if first:
        yield pa.RecordBatch.from_arrays([first.column(0), first.column(1), pa.array([total])], names=["trial", "part", "sums"])


def rows_at_a_time(trials: int, n_params: int) -> int:
    """Rows whose intermediate arrays stay within :data:`_WORK_CELLS`."""
    return max(1, _WORK_CELLS // max(1, trials * 16, n_params))


def class_labels(column: pa.Array, classes: int | None, name: str) -> np.ndarray:
    """Labels as integers, none missing and each one of the classes."""
    if column.null_count:
        raise ValueError(f"missing labels in {name}")
    y = column.to_numpy(zero_copy_only=False).astype(np.int64)
    if len(y) and (y.min() < 0 or classes is not None and y.max() >= classes):
        raise ValueError(f"labels in {name} outside 0 to {classes - 1 if classes else '...'}")
    return y


def feature_width(trainable: Trainable) -> int | None:
    if hasattr(trainable, "width"):
        return trainable.width
    side = getattr(trainable, "side", None)
    return side * side if side else None


def training_pass(
    df: DataFrame,
    trainable: Trainable,
    params: np.ndarray,
    features: str,
    label: str,
    is_test: str = "is_test",
    max_tasks: int | None = None,
) -> PassResult:
    """One pass over the rows for all trials, in blocks of trials that fit a broadcast."""
    if trainable.n_params * 8 > MAX_BROADCAST_BYTES:
        raise ValueError("the model is too large for one broadcast")
    block = max(1, MAX_BROADCAST_BYTES // (8 * (trainable.n_params + 4)))
    sums = np.zeros((len(params), trainable.n_params + 4))
    for start in range(0, len(params), block):
        part = df.sparkSession.sparkContext.broadcast(params[start : start + block])
        cells = partial_sums(df, trainable, part, features, label, is_test, max_tasks).toArrow()
        part.destroy()  # a search makes one for every iteration
        trial, pos = (cells.column(name).to_numpy().astype(np.int64) for name in ("trial", "pos"))
        sums[start + trial, pos] = cells.column("value").to_numpy()
    if not len(params):
        return PassResult(sums[:, :-4], sums[:, -4], 0, sums[:, -2], 0)
    return PassResult(sums[:, :-4], sums[:, -4], int(sums[0, -3]), sums[:, -2], int(sums[0, -1]))


def momentum_step(
    params: np.ndarray, velocity: np.ndarray, gradient: np.ndarray, lr: np.ndarray, momentum: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``v = m v + g; w = w - lr v`` for every trial."""
    velocity = momentum[:, None] * velocity + gradient
    return params - lr[:, None] * velocity, velocity


def minibatch_epoch(
    trainable: Trainable,
    params: np.ndarray,
    velocity: np.ndarray,
    x: np.ndarray,
    y: np.ndarray,
    lr: float,
    momentum: float,
    batch_size: int,
) -> tuple[np.ndarray, np.ndarray]:
    """One trial's epoch over a bounded sample, one step for each mini-batch."""
    params, velocity = params[None], velocity[None]
    rates, momenta = np.array([lr]), np.array([momentum])
    for start in range(0, len(x), batch_size):
        rows = slice(start, start + batch_size)
        grads, _ = trainable.gradient(params, x[rows], y[rows])
        params, velocity = momentum_step(params, velocity, grads / len(x[rows]), rates, momenta)
    return params[0], velocity[0]



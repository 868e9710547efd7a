"""Vector arithmetic on array columns, evaluated inside the JVM."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body``.

    A plain column used inside a lambda is evaluated again for every element;
    binding it to a lambda variable keeps the functions below linear.
    """
    return F.transform(F.array(value), body).getItem(0)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def softmax(logits: Column) -> Column:
    """Class probabilities; the largest logit is subtracted first."""
    return let(
        F.array_max(logits).cast("double"),
        lambda peak: let(
            F.transform(logits, lambda z: F.exp(z.cast("double") - peak)),
            lambda powers: let(array_sum(powers), lambda total: F.transform(powers, lambda p: p / total)),
        ),
    )


def log_softmax(logits: Column) -> Column:
    """Log of :func:`softmax`, without taking the log of a tiny quotient."""
    return let(
        F.array_max(logits).cast("double"),
        lambda peak: let(
            peak + F.ln(array_sum(F.transform(logits, lambda z: F.exp(z.cast("double") - peak)))),
            lambda norm: F.transform(logits, lambda z: z.cast("double") - norm),
        ),
    )


def linear(features: Column, weights: Sequence[Sequence[float]], bias: Sequence[float] | None = None) -> Column:
    """``W x + b`` with one row of ``weights`` per class, folded into the plan as a literal.

    For small weights. Array lambdas are interpreted, so with hundreds of weights
    ``scoring.score_logits``, which multiplies whole batches, is several times faster.
    """
    bias = [0.0] * len(weights) if bias is None else list(bias)
    rows = [{"w": [float(v) for v in row], "b": float(b)} for row, b in zip(weights, bias)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<w: array<double>, b: double>>")
    return F.transform(
        table,
        lambda row: F.aggregate(
            F.zip_with(features, row["w"], lambda x, w: x.cast("double") * w),
            row["b"],
            lambda total, v: total + v,
        ),
    )


def relu(values: Column) -> Column:
    return F.transform(values, lambda v: F.greatest(v.cast("double"), F.lit(0.0)))


def normalise(values: Column, mean: Sequence[float], std: Sequence[float], plane: int | None = None) -> Column:
    """``(x - mean) / std``; with several channels, ``plane`` is the number of values in each."""
    if len(mean) != len(std):
        raise ValueError("mean and std need one value per channel")
    if len(mean) == 1:
        return F.transform(values, lambda v: (v.cast("double") - mean[0]) / std[0])
    if not plane:
        raise ValueError("plane is needed with more than one channel")
    means, stds = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std))

    def scaled(v: Column, i: Column) -> Column:
        channel = F.floor(i / plane).cast("int") + 1
        return (v.cast("double") - F.element_at(means, channel)) / F.element_at(stds, channel)

    return F.transform(values, scaled)


def argmax(values: Column) -> Column:
    """Index of the largest value, the lowest index on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def top_k(values: Column, k: int = 5) -> Column:
    """The ``k`` largest values as ``array<struct<class_id, score>>``, best first, lowest index on a tie."""
    # sort_array compares structs natively; array_sort would call a lambda for every comparison.
    ranked = F.sort_array(
        F.transform(values, lambda v, i: F.struct((-v).alias("order"), i.alias("class_id"), v.alias("score")))
    )
    return F.transform(
        F.slice(ranked, 1, k),
        lambda r: F.struct(r["class_id"].cast("int").alias("class_id"), r["score"].alias("score")),
    )

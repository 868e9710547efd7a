"""Accuracy and loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kilnwork.functions import tensor


def pair_with_targets(predictions: DataFrame, targets: DataFrame, on: str) -> DataFrame:
    """Join predictions with targets kept in another table.

    Not needed when the targets are at hand while scoring: carry them through
    with ``keep`` instead and save the shuffle.
    """
    return predictions.join(targets, on, "inner")


def accuracy(df: DataFrame, predicted: str = "predicted_class", label: str = "label") -> DataFrame:
    """``correct, total, accuracy`` in one row; accuracy is NULL without rows."""
    hit = F.count_if(F.col(predicted) == F.col(label))
    return df.agg(
        hit.alias("correct"),
        F.count(F.lit(1)).alias("total"),
        F.try_divide(hit, F.count(F.lit(1))).alias("accuracy"),
    )


def accuracy_value(df: DataFrame, predicted: str = "predicted_class", label: str = "label") -> float:
    value = accuracy(df, predicted, label).first()["accuracy"]
    if value is None:
        raise ValueError("no rows to evaluate")
    return value


def mean_nll(df: DataFrame, logits: str, label: str = "label") -> DataFrame:
    """Mean negative log-likelihood of the labels."""
    picked = F.element_at(tensor.log_softmax(F.col(logits)), F.col(label).cast("int") + 1)
    return df.agg(F.avg(-picked).alias("mean_nll"), F.count(F.lit(1)).alias("rows"))

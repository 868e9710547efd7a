"""Hash splits, shuffles and bounded samples of labelled rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from kilnwork.functions import draws

# Mini-batch size, and the row caps of a training epoch and a test pass.
BATCH_SIZE = 64
EPOCH_CAP = 512
TEST_CAP = 256


def split_train_test(df: DataFrame, key: str, test_share: float = 0.2, seed: str = "split") -> DataFrame:
    """Mark each row ``is_test`` by the hash of its key. No shuffle, same answer on every run."""
    bound = f"{int(test_share * (1 << 32)):08x}"
    return df.withColumn("is_test", F.substring(draws.hash_order(F.col(key), seed), 1, 8) < bound)


def shuffle_rows(df: DataFrame, key: str, seed: str, partitions: int | None = None) -> DataFrame:
    """Rows in a random order within random partitions: one shuffle and no global sort."""
    order = draws.hash_order(F.col(key), seed)
    spread = (partitions, order) if partitions else (order,)
    return df.repartition(*spread).sortWithinPartitions(order)


def rows_within_cap(cap: int, batch_size: int = BATCH_SIZE) -> int:
    """Rows in the batches whose start is not past ``cap``: 576 for 512, 320 for 256."""
    return (cap // batch_size + 1) * batch_size


def likely_rows(df: DataFrame, key: str, n: int, seed: str, total: int) -> DataFrame:
    """A part of ``df`` that almost surely holds the first ``n`` of ``total`` rows in hash order.

    On a large table the scan keeps only rows below a hash bound that about
    ``n`` rows pass, with a margin of ten standard deviations, so a top-n over
    it sees a few hundred rows instead of ``n`` from every task.
    """
    wanted = n + 10 * math.sqrt(n) + 50
    if total <= 4 * wanted:
        return df
    bound = f"{int(wanted / total * (1 << 32)):08x}"
    return df.filter(F.substring(draws.hash_order(F.col(key), seed), 1, 8) < bound)


def first_rows(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    return df.withColumn("sample_order", draws.hash_order(F.col(key), seed)).orderBy("sample_order", key).limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """The ``n`` rows that come first in the hash order of ``seed``."""
    near = likely_rows(df, key, n, seed, df.count())
    if near is not df and near.select(key).limit(n).count() < n:
        near = df
    return first_rows(near, key, n, seed)


def epoch_sample(
    df: DataFrame, key: str, cap: int = EPOCH_CAP, batch_size: int = BATCH_SIZE, seed: str = "epoch"
) -> DataFrame:
    """Rows of one epoch in whole batches, with their ``batch_index``."""
    sample = hash_sample(df, key, rows_within_cap(cap, batch_size), seed)
    # One window over a sample of at most ``rows_within_cap`` rows.
    position = F.row_number().over(Window.orderBy("sample_order", key)) - 1
    return sample.withColumn("batch_index", F.floor(position / batch_size).cast("int")).drop("sample_order")


def samples_of_iterations(df: DataFrame, key: str, wanted: dict[str, int], total: int) -> DataFrame:
    """For each seed of ``wanted`` a part of ``df`` that almost surely holds its first rows in hash order, in one scan.

    Each row comes once for every ``seed`` whose hash bound it passes, with that seed's ``sample_order``; about the
    wanted numbers of rows in all, however large the table is.
    """
    hits = []
    for seed, n in wanted.items():
        order = draws.hash_order(F.col(key), seed)
        enough = n + 10 * math.sqrt(n) + 50
        near = F.lit(True)
        if total > 4 * enough:
            near = F.substring(order, 1, 8) < f"{int(enough / total * (1 << 32)):08x}"
        hits.append(F.when(near, F.struct(F.lit(seed).alias("seed"), order.alias("sample_order"))))
    picked = df.withColumn("_hit", F.explode(F.array_compact(F.array(*hits))))
    return picked.select("*", "_hit.*").drop("_hit")

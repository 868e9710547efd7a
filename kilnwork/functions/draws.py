"""Repeatable pseudo-random draws from ids, equal on every run and partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def hash_order(key: Column, seed: str) -> Column:
    """A sort key that shuffles rows; change ``seed`` for another order."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(key.cast("string"), F.lit(""))))


def unit_draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 32 bits of the hash."""
    return F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("double") / float(1 << 32)


def uniform(key: Column, low: float, high: float, seed: str) -> Column:
    return F.lit(low) + unit_draw(key, seed) * F.lit(high - low)


def log_uniform(key: Column, low: float, high: float, seed: str) -> Column:
    span = math.log(high) - math.log(low)
    return F.exp(F.lit(math.log(low)) + unit_draw(key, seed) * F.lit(span))

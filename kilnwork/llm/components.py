"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of the edges ``a``, ``b``.

    Each round moves every node to the neighbour, or itself, that comes first in an order drawn anew by hash, and keeps
    the edges between what is left. The graph shrinks by a share in every round whatever its shape, so that all rounds
    together handle a small multiple of its edges. Each round's moves are a table in shared scratch space; only a count
    comes to the driver.
    """
    left = materialise(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while left.limit(1).count():
        at = len(moves)
        both = left.select("a", "b").union(left.select("b", "a"))
        found = both.groupBy("a").agg(F.min(_ranked("b", at)).alias("first"))
        found = found.select("a", F.least("first", _ranked("a", at))["node"].alias("to"))
        found = materialise(found, "moves")
        moves.append(found)
        moved = left.join(found, "a").select(F.col("to").alias("c"), "b")
        moved = moved.join(found.toDF("b", "d"), "b").filter("c <> d")
        left = materialise(moved.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    # From the last round back: where a node of a round went in the end.
    ends = moves[-1].toDF("node", "end")
    for found in reversed(moves[:-1]):
        later = ends.toDF("to", "end")
        ends = found.join(later, "to", "left").select(F.col("a").alias("node"), F.coalesce("end", "to").alias("end"))
        ends = materialise(ends, "ends")
    least = ends.groupBy("end").agg(F.min("node").alias("root"))
    return materialise(ends.join(materialise(least, "roots"), "end").select("node", "root"), "components")


def _ranked(node: str, at: int) -> Column:
    """A node that sorts by a hash, another in each round."""
    return F.struct(F.xxhash64(node, F.lit(at)).alias("rank"), F.col(node).alias("node"))

"""Hard negatives by rotated one-bit codes.

Each vector keeps, beside itself, the signs of its rotated components, its inner product with the unit vector of those
signs, and the length of what that vector leaves over. A query's rotated components are rounded to a few bits, so that its
inner product with a sign vector is a sum of population counts. By the inequality of Cauchy and Schwarz this bounds the
true product from both sides; only rows whose interval can still matter are scored, in integers.

Queries meet all rows in blocks of bounded size: each task holds one block of either, and gives back a few rows a query.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwork.session import materialise

#: Components are scaled by this and rounded down before they are multiplied.
SCALE = 256
#: Most positives of an anchor, most negatives of a positive, and the least and greatest share of its score in percent.
POSITIVES, NEGATIVES, SHARES = 5, 5, (80, 100)
#: Bits of a query's components, and most rows and queries in a block.
QUERY_BITS, BLOCK_ROWS, BLOCK_QUERIES = 6, 1 << 16, 1 << 14
_EXACT = 2.0**53
_LONG = 2**63 - 1


@functools.lru_cache(maxsize=4)
def _signs(width: int) -> np.ndarray:
    return np.random.default_rng(width).choice([-1.0, 1.0], (2, width))


def rotate(x: np.ndarray) -> np.ndarray:
    """An orthogonal turn of the rows, whose width is a power of two: random signs and a Hadamard transform, twice."""
    n, width = x.shape
    for signs in _signs(width):
        x = x * signs
        h = 1
        while h < width:
            pairs = x.reshape(n, width // (2 * h), 2, h)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            h *= 2
        x = x / np.sqrt(width)
    return x


def padded_width(width: int) -> int:
    return max(64, 1 << max(width - 1, 0).bit_length())


@dataclass
class Codes:
    """Rows of a block: bits of the signs, product with the sign vector, length left over, and the rows themselves."""

    bits: np.ndarray
    ones: np.ndarray
    aligned: np.ndarray
    residual: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        turned = rotate(np.pad(vectors, ((0, 0), (0, padded_width(vectors.shape[1]) - vectors.shape[1]))))
        bits = np.packbits(turned >= 0, axis=1, bitorder="little").view("<u8")
        aligned = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
        residual = np.sqrt(np.maximum((turned**2).sum(axis=1) - aligned**2, 0.0))
        return cls(bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64), aligned, residual, vectors)

    def part(self, rows: slice | np.ndarray) -> Codes:
        return Codes(self.bits[rows], self.ones[rows], self.aligned[rows], self.residual[rows], self.vectors[rows])


class Query:
    """A query's rounded components as bit planes, and what rounding leaves over."""

    def __init__(self, vector: np.ndarray):
        self.vector = vector
        turned = rotate(np.pad(vector, (0, padded_width(len(vector)) - len(vector)))[None])[0]
        self.width, self.low = len(turned), turned.min()
        self.step = (turned.max() - self.low) / (2**QUERY_BITS - 1)
        levels = np.rint((turned - self.low) / self.step).astype(np.uint8) if self.step > 0 else np.zeros(self.width, np.uint8)
        rounded = self.low + self.step * levels
        self.total, self.size = rounded.sum(), np.sqrt((turned**2).sum())
        self.rest = np.sqrt(((turned - rounded) ** 2).sum())
        self.planes = [np.packbits(levels >> k & 1, bitorder="little").view("<u8") for k in range(QUERY_BITS)]

    def interval(self, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products with ``rows``."""
        sums = np.zeros(len(rows.bits), np.int64)
        for k, plane in enumerate(self.planes):
            for word in np.flatnonzero(plane):
                sums += np.bitwise_count(rows.bits[:, word] & plane[word]).astype(np.int64) << k
        along = (2 * (self.low * rows.ones + self.step * sums) - self.total) / np.sqrt(self.width)
        across = np.sqrt(np.maximum(self.size**2 - np.maximum(np.abs(along) - self.rest, 0.0) ** 2, 0.0))
        middle = rows.aligned * along
        reach = rows.aligned * self.rest + rows.residual * across
        reach += 1e-9 * self.size * (rows.aligned + rows.residual) + 1e-6  # what floating point may lose
        return middle - reach, middle + reach

    def scores(self, rows: Codes) -> np.ndarray:
        """Exact integer products; beyond 64 bits the greatest or least long."""
        if np.abs(rows.vectors).sum(axis=1).max(initial=0.0) * np.abs(self.vector).max(initial=0.0) < _EXACT:
            return (rows.vectors @ self.vector).astype(np.int64)
        mine = [int(v) for v in self.vector]
        exact = [sum(int(a) * b for a, b in zip(row, mine, strict=True)) for row in rows.vectors]
        return np.array([min(max(s, -_LONG), _LONG) for s in exact], np.int64)


def _first(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Rows with the highest scores, the smallest id first among equal ones."""
    if len(scores) > 4 * most:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
        return some[np.lexsort((ids[some], -scores[some]))[:most]]
    return np.lexsort((ids, -scores))[:most]


def _best(query: Query, rows: Codes, most: int) -> np.ndarray:
    """Rows that can be among the ``most`` highest: those whose interval reaches the last of the best few by estimate."""
    if len(rows.bits) <= most:
        return np.arange(len(rows.bits))
    low, high = query.interval(rows)
    few = min(8 * most, len(low))
    seeds = np.argpartition(low + high, len(low) - few)[len(low) - few :]
    return np.flatnonzero(high >= np.partition(query.scores(rows.part(seeds)), few - most)[few - most])


def usable(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, vector``: rows that have a key, a label and only finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", bad), F.lit(False)))


def _coded(rows: DataFrame, width: int) -> DataFrame:
    """Scaled vectors with their codes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _scaled(batch.column("vector"), width)
                codes = Codes.of(vectors)
                packed = [pa.array([row.tobytes() for row in part], pa.binary()) for part in (codes.bits, vectors)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("vec_id", "label", "anchor")), packed[0], pa.array(codes.aligned), pa.array(codes.residual), packed[1]], _CODED)

    return rows.mapInArrow(run, "vec_id bigint, label bigint, anchor boolean, bits binary, aligned double, residual double, vector binary")


_CODED = ["vec_id", "label", "anchor", "bits", "aligned", "residual", "vector"]


def _scaled(column: pa.ListArray, width: int) -> np.ndarray:
    """Scaled components rounded down, within the longs; missing ones at the end are 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        flat = np.clip(np.floor(SCALE * flat), -(2.0**63), 2.0**63)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _block(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, Codes]:
    """Ids, labels and codes, ordered by label."""
    table = table.sort_by("label").combine_chunks()
    bits, vectors = (np.frombuffer(b"".join(table.column(n).to_pylist()), kind).reshape(len(table), size) for n, kind, size in (("bits", "<u8", padded_width(width) // 64), ("vector", "<f8", width)))
    ids, labels, aligned, residual = (table.column(n).to_numpy() for n in ("vec_id", "label", "aligned", "residual"))
    return ids, labels, Codes(bits, np.bitwise_count(bits).sum(axis=1, dtype=np.int64), aligned, residual, vectors)


def _in_blocks(queries: DataFrame, rows: DataFrame, counts: tuple[int, int], search: Callable, schema: str) -> DataFrame:
    """``search`` over every block of queries with every block of rows. Rows are dealt by place, whatever they hold."""
    least = rows.sparkSession.sparkContext.defaultParallelism
    blocks = [max(1, -(-counts[0] // BLOCK_QUERIES)), max(least, -(-counts[1] // BLOCK_ROWS))]
    dealt = [df.withColumn(own, (F.monotonically_increasing_id() % n).cast("int")) for df, own, n in ((queries, "_q", blocks[0]), (rows, "_r", blocks[1]))]
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in blocks]
    left, right = dealt[0].withColumn("_r", every[1]), dealt[1].withColumn("_q", every[0])
    return left.groupBy("_q", "_r").cogroup(right.groupBy("_q", "_r")).applyInArrow(search, schema)


def _positives(queries: DataFrame, rows: DataFrame, counts: tuple[int, int], width: int, most: int) -> DataFrame:
    """``anchor, positive_id, positive_score``: of each anchor the rows of its label with the highest scores."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            ids, labels, codes = _block(right, width)
            vectors = np.frombuffer(b"".join(left.column("vector").to_pylist()), "<f8").reshape(len(left), width)
            for anchor, own, label, vector in zip(left.column("anchor").to_pylist(), left.column("anchor_id").to_pylist(), left.column("label").to_pylist(), vectors, strict=True):
                start, end = np.searchsorted(labels, [label, label + 1])
                same = start + np.flatnonzero(ids[start:end] != own)
                query, part = Query(vector), codes.part(same)
                near = same[_best(query, part, most)]
                scores = query.scores(codes.part(near))
                top = _first(ids[near], scores, most)
                found.append((np.full(len(top), anchor), ids[near][top], scores[top]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("anchor", "positive_id", "positive_score"), columns, strict=True)))

    rough = _in_blocks(queries, rows, counts, search, "anchor bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), "positive_id")
    return rough.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def _negatives(queries: DataFrame, rows: DataFrame, counts: tuple[int, int], width: int, most: int, shares: tuple[int, int]) -> DataFrame:
    """``anchor, place, negative_id, negative_score``: of each positive the best rows of other labels within its shares."""
    names = ("anchor", "place", "negative_id", "negative_score")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if len(left) and len(right):
            ids, labels, codes = _block(right, width)
            vectors = np.frombuffer(b"".join(left.column("vector").to_pylist()), "<f8").reshape(len(left), width)
            for anchor, label, positives, vector in zip(left.column("anchor").to_pylist(), left.column("label").to_pylist(), left.column("positives").to_pylist(), vectors, strict=True):
                ranges = [(p["place"], -(-shares[0] * p["positive_score"] // 100), shares[1] * p["positive_score"] // 100) for p in positives]
                ranges = [(place, least, greatest) for place, least, greatest in ranges if least <= greatest]
                if not ranges:
                    continue
                query = Query(vector)
                low, high = query.interval(codes)
                some = np.flatnonzero((high >= min(r[1] for r in ranges)) & (low <= max(r[2] for r in ranges)) & (labels != label))
                low, high = low[some], high[some]
                wanted = np.zeros(len(some), bool)
                for _, least, greatest in ranges:
                    can = (high >= least) & (low <= greatest)
                    sure = low[(low >= least) & (high <= greatest)]
                    if len(sure) > most:
                        can &= high >= np.partition(sure, len(sure) - most)[len(sure) - most]
                    wanted |= can
                some = some[wanted]
                scores = query.scores(codes.part(some))
                for place, least, greatest in ranges:
                    inside = np.flatnonzero((scores >= least) & (scores <= greatest))
                    top = inside[_first(ids[some[inside]], scores[inside], most)]
                    found.append((np.full(len(top), anchor), np.full(len(top), place), ids[some[top]], scores[top]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(names, columns, strict=True)))

    rough = _in_blocks(queries, rows, counts, search, "anchor bigint, place bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    return rough.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    rows: DataFrame,
    is_anchor,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = SHARES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows of :func:`usable`.

    Scores are integer products of components times 256, rounded down. Positives are the best other rows of the anchor's
    label, other meaning of another id; negatives the best rows of other labels whose score lies within ``shares`` percent
    of the positive's. Equal scores go by the smaller id. Repeated rows count one by one, and so do repeated anchors.
    Shorter vectors are as if filled with zeros; scores beyond 64 bits count as the greatest or least long. No rows, or no
    anchors, give no rows.
    """
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    coded = materialise(_coded(rows.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), max(width, 1)), "codes")
    n_rows, n_queries = coded.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    queries = coded.filter("anchor").select(F.monotonically_increasing_id().alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "vector")
    queries = materialise(queries, "anchors")
    coded = coded.drop("anchor")
    first = materialise(_positives(queries, coded, (n_queries, n_rows), width, positives), "positives")
    held = first.groupBy("anchor").agg(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), "positive_score")).alias("positives"))  # few each
    second = _negatives(queries.join(held, "anchor"), coded, (n_queries, n_rows), width, negatives, shares)
    named = first.join(queries.select("anchor", "anchor_id"), "anchor").withColumn("place", F.col("place").cast("long"))
    return named.join(second, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )

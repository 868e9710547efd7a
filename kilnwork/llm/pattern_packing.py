"""Packing of token sequences by patterns of lengths.

Only the histogram of piece lengths reaches the driver, at most one count for each length up to the capacity. Patterns of
a few lengths are fitted to it by non-negative least squares, their repeat counts rounded down to what there is, and the
pieces left over go into the remaining room, best fit first. The plan says for each length which of its pieces go where;
the tasks number the pieces of each length and look their places up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwork.llm.memory import release
from kilnwork.llm.near_dedup import batches_of
from kilnwork.llm.word_tokens import word_tokens
from kilnwork.session import materialise

CAPACITY = 4096
#: The id after each document's ids.
END = 1
#: Size classes of the fit, and most pieces in a pattern.
CLASSES, FEW = 128, 3


def patterns(classes: int = CLASSES, few: int = FEW) -> np.ndarray:
    """All multisets of 2 to ``few`` class sizes that fill a sequence: a row each, with the number of each class."""
    found: list[tuple[int, ...]] = []

    def extend(start: tuple[int, ...], most: int, left: int) -> None:
        if left == 0:
            if len(start) > 1:
                found.append(start)
            return
        if len(start) < few:
            for k in range(min(most, left), -(-left // (few - len(start))) - 1, -1):
                extend((*start, k), k, left - k)

    extend((), classes, classes)
    out = np.zeros((len(found), classes + 1), np.int8)
    for row, sizes in enumerate(found):
        np.add.at(out[row], list(sizes), 1)
    return out


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """The ``x >= 0`` with the least ``|a x - b|``, by the active-set method."""
    gram_columns: list[int] = []
    x = np.zeros(a.shape[1])
    scale = tolerance * max(np.abs(a.T @ b).max(initial=0.0), 1e-300)
    for _ in range(3 * a.shape[0]):
        slope = a.T @ (b - a @ x)
        slope[gram_columns] = -np.inf
        enter = int(slope.argmax())
        if slope[enter] <= scale:
            break
        gram_columns.append(enter)
        while True:
            part = np.linalg.lstsq(a[:, gram_columns], b, rcond=None)[0]
            if part.min() > 0:
                break
            now = x[gram_columns]
            falling = part <= 0
            gap = now[falling] - part[falling]
            step = np.min(np.divide(now[falling], gap, out=np.zeros_like(gap), where=gap > 0))
            moved = now + step * (part - now)
            moved[falling & (moved <= 1e-12 * max(1.0, np.abs(moved).max()))] = 0.0
            if (moved > 0).all():
                moved[falling] = 0.0
            x[gram_columns] = moved
            gram_columns = [c for c, v in zip(gram_columns, moved, strict=True) if v > 0]
            if not gram_columns:
                part = np.zeros(0)
                break
        x[:] = 0.0
        x[gram_columns] = part
    return x


@dataclass
class Group:
    """Sequences that hold pieces of the same lengths."""

    lengths: tuple[int, ...]
    count: int


def plan(histogram: np.ndarray, classes: int = CLASSES, few: int = FEW) -> list[Group]:
    """Groups of sequences for ``histogram[length]`` pieces of each length up to the capacity, its last index.

    The number of groups follows the capacity, not the number of pieces.
    """
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    groups = [Group((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    open_groups: dict[int, list[Group]] = {}
    for group in _pattern_groups(left, classes, few):
        open_groups.setdefault(capacity - sum(group.lengths), []).append(group)
    _best_fit(left, open_groups, capacity)
    return groups + [g for same in open_groups.values() for g in same]


def _pattern_groups(left: np.ndarray, classes: int, few: int) -> list[Group]:
    """Fits the patterns and takes their pieces from ``left``. The last piece of each is left to the best fit."""
    capacity = len(left) - 1
    classes = min(classes, capacity)
    lengths = np.arange(capacity + 1)
    which = -(-lengths * classes // capacity)
    counts = np.bincount(which, left, classes + 1)
    held = patterns(classes, few)
    held = held[(held[:, counts == 0] == 0).all(axis=1)] if len(held) else held
    if not len(held):
        return []
    # Long pieces weigh more: short ones find room anywhere.
    weight = np.arange(classes + 1) / classes
    fitted = nnls(held.T * weight[:, None], counts * weight)
    groups = []
    for row in np.argsort(-fitted, kind="stable"):
        need = np.repeat(np.arange(classes + 1), held[row])[::-1]
        room = min((counts[k] // held[row, k] for k in set(need.tolist())), default=0)
        count = int(min(np.floor(fitted[row]), room))
        if count < 1:
            continue
        taken = [_longest(left, which, int(k), count) for k in need[:-1]]
        # Runs of equal lengths side by side, cut where any of them changes.
        edges = sorted({0, count, *(e for runs in taken for e in np.cumsum([c for _, c in runs]).tolist())})
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            groups += _filled(Group(tuple(_at(runs, start) for runs in taken), end - start), left)
        counts = np.bincount(which, left, classes + 1)
    return groups


def _filled(group: Group, left: np.ndarray) -> Iterator[Group]:
    """The last piece of a pattern is the longest there is for the room, whatever its class."""
    room, count = len(left) - 1 - sum(group.lengths), group.count
    while count:
        fits = np.flatnonzero(left[: room + 1])
        if not len(fits):
            yield Group(group.lengths, count)
            return
        length = int(fits[-1])
        take = int(min(count, left[length]))
        left[length] -= take
        count -= take
        yield Group((*group.lengths, length), take)


def _longest(left: np.ndarray, which: np.ndarray, k: int, count: int) -> list[tuple[int, int]]:
    """Takes ``count`` pieces of a class, the longest first: lengths and how many of each."""
    runs = []
    for length in np.flatnonzero((which == k) & (left > 0))[::-1].tolist():
        take = int(min(count, left[length]))
        left[length] -= take
        runs.append((length, take))
        count -= take
        if not count:
            break
    return runs


def _at(runs: list[tuple[int, int]], index: int) -> int:
    for length, count in runs:
        if index < count:
            return length
        index -= count
    raise IndexError(index)


def _best_fit(left: np.ndarray, open_groups: dict[int, list[Group]], capacity: int) -> None:
    """Places the pieces left, the longest first, each where the least room stays; many equal ones in one step."""
    rooms = np.zeros(capacity + 1, bool)
    rooms[list(open_groups)] = True
    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        left[length] = 0
        while count:
            fits = np.flatnonzero(rooms[length:])
            if not len(fits):
                each = capacity // length
                whole, rest = divmod(count, each)
                for n, times in ((each, whole), (rest, 1 if rest else 0)):
                    if times:
                        room = capacity - n * length
                        open_groups.setdefault(room, []).append(Group((length,) * n, times))
                        rooms[room] = True
                break
            room = length + int(fits[0])
            same = open_groups[room]
            group = same.pop()
            if group.count > count:
                same.append(Group(group.lengths, group.count - count))
                group = Group(group.lengths, count)
            if not same:
                rooms[room] = False
            count -= group.count
            group.lengths += (length,)
            open_groups.setdefault(room - length, []).append(group)
            rooms[room - length] = True


def slots(groups: list[Group], capacity: int) -> np.ndarray:
    """Where the pieces of a length go, by their number: ``key, each, sequence, offset, length``, ordered by key.

    ``key`` is the length and the first number of the slot in one integer; ``each`` pieces in a row share a sequence.
    """
    if capacity >= 1 << _LENGTH_BITS:
        raise ValueError(f"the capacity must be below {1 << _LENGTH_BITS}")
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for group in groups:
        offset = at = 0
        while at < len(group.lengths):
            length, each = group.lengths[at], 1
            while at + each < len(group.lengths) and group.lengths[at + each] == length:
                each += 1
            rows.append((length << _NUMBER_BITS | int(used[length]), each, sequence, offset, length))
            used[length] += each * group.count
            offset += each * length
            at += each
        sequence += group.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_LENGTH_BITS, _NUMBER_BITS = 18, 44


def cut(docs: DataFrame, model: str, text: str, keep: list[str], capacity: int, end: int, with_ids: bool) -> DataFrame:
    """Pieces of each document: ``keep`` as ``k0, k1, ...``, place, checksum, and the piece's number among those of its length in its task."""
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    fields = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names]
    fields += ["piece int", "start bigint", "length bigint", "ids_crc32 bigint", "task int", "number bigint"]
    fields += ["ids array<int>"] if with_ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        tokens = word_tokens(model)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            release()
            for part in batches_of(batch, 2 << 20):
                rows, places, held = [], [], []
                for row, ids in enumerate(tokens.encode(part.column("text").to_pylist())):
                    ids = np.append(ids, np.uint32(end))
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        one = ids[start : start + capacity]
                        rows.append(row)
                        places.append((piece, start, len(one), zlib.crc32(one.astype("<u4").tobytes()), task, seen[len(one)]))
                        seen[len(one)] += 1
                        if with_ids:
                            held.append(one.astype(np.int32))
                taken = part.take(pa.array(rows, pa.int64()))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                columns = [*(taken.column(n) for n in names)]
                columns += [pa.array(list(c), k) for c, k in zip(zip(*places, strict=True), kinds, strict=True)] if places else [pa.array([], k) for k in kinds]
                columns += [pa.array(held, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in fields])
        tokens.forget()
        release()

    return source.mapInArrow(run, ", ".join(fields))


def pack(
    docs: DataFrame,
    model: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """``keep`` columns with ``piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``), one row for each piece.

    A document is its ids and ``end``; only longer ones than ``capacity`` are cut. Pieces of a sequence lie side by side
    from 0. ``model`` is the text of a tokenizers file. Null texts count as empty, which leaves ``end`` alone; repeated
    rows, equal or null keys are packed row by row; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    keep = list(keep)
    pieces = materialise(cut(docs, model, text, keep, capacity, end, with_ids), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row for each length at most
        histogram[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(slots(plan(histogram), capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    names = [f"k{i}" for i in range(len(keep))]
    numbered = pieces.join(earlier, ["task", "length"]).select(
        *names, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), (F.col("number") + F.col("earlier")).alias("number")
    )
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number"]
    fields += ["sequence_id bigint", "offset bigint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, each, sequence, offset, length = places.value.T
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = (batch.column("length").to_numpy() << _NUMBER_BITS) | batch.column("number").to_numpy()
            slot = np.searchsorted(key, wanted, side="right") - 1
            nth = wanted - key[slot]
            ids = [pa.array(sequence[slot] + nth // each[slot]), pa.array(offset[slot] + nth % each[slot] * length[slot])]
            yield pa.RecordBatch.from_arrays([*(c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "number"), *ids], [f.split(" ")[0] for f in fields])

    return numbered.mapInArrow(run, ", ".join(fields)).withColumnsRenamed(dict(zip(names, keep, strict=True)))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, the ``ids`` of its pieces in a row and the ``offsets`` they begin at, from :func:`pack` ``with_ids``."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most as many as the capacity
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.offset").alias("offsets")
    )

"""Ends of logs that arrive in parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kilnwork.functions.text import LOG_TAIL_CHARS

# Groups of tasks whose ends are joined first.
_FAN_IN = 64
_NOTHING = (None, "", "")


def _ends(rows: list[tuple], chars: int) -> list[tuple]:
    """Of ``(order, tie, text)`` parts the last ones that hold ``chars`` characters, the first of them cut to fit, in order."""
    kept, room = [], chars
    for order, tie, text in sorted(rows, key=lambda r: ((r[0] is not None, r[0]) if r[0] is not None else (False,), r[1]), reverse=True):
        if not room:
            break
        if text:
            kept.append((order, tie, text[-room:]))
            room -= min(room, len(text))
    return kept[::-1]


def tail_of_parts(
    parts: DataFrame, key: str, order: str, text: str, chars: int = LOG_TAIL_CHARS
) -> DataFrame:
    """``key`` and ``tail``: the last characters of each log, whose parts joined by ``order`` are the whole log.

    A part can only matter if later parts leave room for it, which holds for any of a log's parts as for all. Each task
    therefore drops what its own later parts cover, before anything is moved, and the ends that are left are joined in two
    steps: no task holds more than ``chars`` characters of a log from each of the tasks before it. Parts without order come
    first, those of equal order by the MD5 of their text; NULL texts are empty.
    """
    kind, place = (parts.schema[c].dataType for c in (key, order))
    names = ["key", "at", "tie", "text", "part"]
    schema = f"key {kind.simpleString()}, at {place.simpleString()}, tie string, text string, part int"
    said = F.coalesce(text, F.lit(""))
    rows = parts.select(F.col(key).alias("key"), F.col(order).alias("at"), F.md5(said.cast("binary")).alias("tie"), said.alias("text"))

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % _FAN_IN
        for batch in batches:
            logs: dict[object, list[tuple]] = {}
            for name, at, tie, said in zip(*(batch.column(c).to_pylist() for c in names[:4]), strict=True):
                if said:
                    logs.setdefault(name, []).append((at, tie, said[-chars:]))
                elif name not in logs:
                    logs[name] = []
            # A log without text keeps a row, so that it is not lost.
            left = [(name, *end, part) for name, held in logs.items() for end in (_ends(held, chars) or [_NOTHING])]
            kinds = [batch.schema.field("key").type, batch.schema.field("at").type, pa.string(), pa.string(), pa.int32()]
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*left, strict=True), kinds, strict=True)], names)

    def gather(batches: Iterator[pa.RecordBatch]) -> tuple[pa.RecordBatch, list[tuple]]:
        held, first = [], None
        for batch in batches:
            first = first if first is not None else batch.slice(0, 1)
            held = _ends([*held, *zip(*(batch.column(c).to_pylist() for c in names[1:4]), strict=True)], chars)
        return first, held

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = gather(batches)
        held = held or [_NOTHING]
        at, ties, said = zip(*held, strict=True)
        n = len(held)
        columns = [pa.array(first.column("key").to_pylist() * n, first.schema.field("key").type), pa.array(list(at), first.schema.field("at").type), pa.array(list(ties), pa.string()), pa.array(list(said), pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([0] * n, pa.int32())], names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = gather(batches)
        yield pa.RecordBatch.from_arrays([first.column("key"), pa.array(["".join(t for _, _, t in held)], pa.string())], [key, "tail"])

    short = rows.mapInArrow(shorten, schema)
    once = short.groupBy("key", "part").applyInArrow(join, schema)
    return once.groupBy("key").applyInArrow(finish, f"`{key}` {kind.simpleString()}, tail string")

"""Linear scores as a blocked matrix product.

Rows are packed into blocks of some rows and positions, weights into blocks of some classes and positions. A join brings
together the blocks that share positions, each pair gives partial logits, and those of the same rows and classes are
added. Rows are read once, and neither side has to fit a broadcast or a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kilnwork.operators import batches
from kilnwork.operators.scoring import ON_ERROR, TOP_K
from kilnwork.session import materialise

# Rows, classes and positions of a block: a block of doubles is at most 32 MB.
BLOCK_ROWS, BLOCK_CLASSES, BLOCK_POSITIONS = 4096, 1024, 1024
# Blocks of one stretch of positions are dealt into so many groups, so that few positions still use many tasks.
_SALTS = 16

_BIAS = -1
_PACKED = "chunk bigint, span bigint, salt int, ids binary, x binary, lost binary"
_PARTIAL = "chunk bigint, band bigint, span bigint, ids binary, lost binary, classes binary, logits binary"
_RANKED = "chunk bigint, band bigint, ids binary, lost binary, k int, classes binary, logits binary, peak binary, total binary"


def _pack_rows(rows: DataFrame, width: int, positions: int, block_rows: int) -> DataFrame:
    """Blocks of the ``x`` of ``row, x``. Rows without usable ``x`` are zeros, and marked."""
    spans = max(1, -(-width // positions))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                x, usable = batches.vectors(part.column("x"), width)
                x, ids = x.astype(np.float64, copy=False), part.column("row").to_numpy()
                chunk, lost = int(ids[0]), (~usable).tobytes()
                for span in range(spans):
                    cells = np.ascontiguousarray(x[:, span * positions : (span + 1) * positions])
                    values = [[chunk], [span], [chunk % _SALTS], [ids.tobytes()], [cells.tobytes()], [lost]]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["chunk", "span", "salt", "ids", "x", "lost"])

    return rows.mapInArrow(run, _PACKED)


def _pack_weights(weights: DataFrame, width: int, classes: int, positions: int) -> DataFrame:
    """``band, span, classes, w``: a block of weights; those of the bias are in the first span, as its last column.

    A class is in every span, with zeros where it has no weights. A cell that is there twice counts with its sum.
    """
    spans = max(1, -(-width // positions))
    known = weights.filter("class_id is not null").select(F.col("class_id").cast("long").alias("class_id"), F.col("pos").cast("long").alias("pos"), F.col("weight").cast("double").alias("weight"))
    cells = known.groupBy("class_id", "pos").agg(F.sum("weight").alias("weight"))
    span = F.when(F.col("pos") == _BIAS, 0).otherwise(F.floor(F.col("pos") / positions))
    # One empty cell in each span names the class there.
    every = known.select("class_id").distinct().select("class_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spans - 1).cast("long"))).alias("span"))
    placed = cells.select("class_id", span.cast("long").alias("span"), "pos", "weight").unionByName(every, allowMissingColumns=True)
    placed = placed.withColumn("band", F.floor(F.col("class_id") / classes))

    def block(table: pa.Table) -> pa.Table:
        ids = np.unique(table.column("class_id").to_numpy())
        span = table.column("span")[0].as_py()
        size = max(0, min(positions, width - span * positions))
        w = np.zeros((len(ids), size + 1))
        real = table.filter(table.column("pos").is_valid())
        pos = real.column("pos").to_numpy()
        w[np.searchsorted(ids, real.column("class_id").to_numpy()), np.where(pos == _BIAS, size, pos - span * positions)] = real.column("weight").to_numpy()
        return pa.table({"band": [table.column("band")[0].as_py()], "span": [span], "classes": [ids.astype(np.int64).tobytes()], "w": [w.tobytes()]})

    return placed.groupBy("band", "span").applyInArrow(block, "band bigint, span bigint, classes binary, w binary")


def _multiplied(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for row in batch.to_pylist():
            n, k = len(row["ids"]) // 8, len(row["classes"]) // 8
            x, w = (np.frombuffer(row[c]).reshape(size, -1) if row[c] else np.zeros((size, 0)) for c, size in (("x", n), ("w", k)))
            logits = x @ w[:, :-1].T + w[:, -1]
            yield pa.RecordBatch.from_pylist([{**{c: row[c] for c in ("chunk", "band", "span", "ids", "lost", "classes")}, "logits": logits.tobytes()}], _schema(_PARTIAL))


def _schema(fields: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in fields.split(", "))])


def _ranked(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partial logits of some rows and classes, and keeps the best classes and what the softmax needs."""
    total, first = None, None
    for batch in blocks:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            first = first or {c: one.column(c)[0].as_py() for c in ("chunk", "band", "ids", "lost", "classes")}
            part = np.frombuffer(one.column("logits")[0].as_py())
            total = part if total is None else total + part
    classes = np.frombuffer(first.pop("classes"), np.int64)
    logits = total.reshape(-1, len(classes))
    k = min(TOP_K, len(classes))
    top = np.argsort(-logits, axis=1, kind="stable")[:, :k]
    peak = logits.max(axis=1)
    row = {**first, "k": k, "classes": classes[top].tobytes(), "logits": np.take_along_axis(logits, top, 1).tobytes()}
    row |= {"peak": peak.tobytes(), "total": np.exp(logits - peak[:, None]).sum(axis=1).tobytes()}
    yield pa.RecordBatch.from_pylist([row], _schema(_RANKED))


def _finished(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best classes and scores of some rows over all bands of classes, one band after the other."""
    held: dict[int, dict] = {}
    for batch in blocks:
        for row in batch.to_pylist():
            held[row["band"]] = row
    classes = logits = peak = total = None
    for band in sorted(held):  # lower classes first, so that a stable sort keeps the lowest on a tie
        row = held[band]
        n, k = len(row["ids"]) // 8, row["k"]
        more = np.frombuffer(row["classes"], np.int64).reshape(n, k), np.frombuffer(row["logits"]).reshape(n, k)
        own_peak, own_total = np.frombuffer(row["peak"]), np.frombuffer(row["total"])
        if classes is None:
            classes, logits, peak, total = *more, own_peak, own_total
            continue
        classes, logits = np.concatenate([classes, more[0]], 1), np.concatenate([logits, more[1]], 1)
        top = np.argsort(-logits, axis=1, kind="stable")[:, :TOP_K]
        classes, logits = np.take_along_axis(classes, top, 1), np.take_along_axis(logits, top, 1)
        new = np.maximum(peak, own_peak)
        total, peak = total * np.exp(peak - new) + own_total * np.exp(own_peak - new), new
    any_row = next(iter(held.values()))
    scores = np.exp(logits - peak[:, None]) / total[:, None]
    offsets = pa.array(np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.frombuffer(any_row["ids"], np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(classes.ravel().astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(scores.ravel())),
            pa.array(np.frombuffer(any_row["lost"], np.bool_)),
        ],
        names=["row", "ids", "scores", "lost"],
    )


def score_join(
    df: DataFrame,
    weights: DataFrame,
    *,
    features: str,
    path: str | None = "path",
    keep: Sequence[str] = (),
    on_error: str = "zero",
    block_rows: int = BLOCK_ROWS,
    block_classes: int = BLOCK_CLASSES,
    block_positions: int = BLOCK_POSITIONS,
) -> DataFrame:
    """The columns and answers of :func:`~kilnwork.operators.scoring.score_linear`, by a join of blocks.

    For weights that exceed a broadcast by far: where that function passes over the rows once for each block of classes,
    this one reads them once and moves a block of them to each band of classes, and the few best classes of each band back.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    if min(block_rows, block_classes, block_positions) < 1:
        raise ValueError("blocks must hold something")
    top = weights.filter("class_id is not null").agg(F.max("pos").alias("pos"), F.count(F.lit(1)).alias("cells")).first()
    if not top["cells"]:
        raise ValueError("the weight table is empty")
    width = max(top["pos"], _BIAS) + 1
    has_path = path is not None and path in df.columns
    numbered = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*keep).alias("kept") if keep else F.struct(F.lit(0)).alias("kept"),
        (F.col(path) if has_path else F.lit(None)).cast("string").alias("file_path"),
        F.col(features).alias("x"),
    )
    numbered = materialise(numbered, "rows")  # the numbers must not change between the two uses
    salted = _pack_weights(weights, width, block_classes, block_positions).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    pairs = _pack_rows(numbered.select("row", "x"), width, block_positions, block_rows).join(salted, ["span", "salt"])
    partial = pairs.select("chunk", "band", "span", "ids", "lost", "classes", "x", "w").mapInArrow(_multiplied, _PARTIAL)
    ranked = partial.groupBy("chunk", "band").applyInArrow(_per_group(_ranked), _RANKED)
    done = ranked.groupBy("chunk").applyInArrow(_per_group(_finished), "row bigint, ids array<int>, scores array<double>, lost boolean")
    if on_error == "fail":
        done = done.withColumn("lost", F.when(F.col("lost"), F.raise_error(F.lit(f"unusable features in {features}")).cast("boolean")).otherwise(False))
    lost = F.col("lost") if on_error == "null" else F.lit(False)
    return numbered.drop("x").join(done, "row").select(
        *(F.col("kept")[name].alias(name) for name in keep),
        F.when(~lost, F.get("ids", F.lit(0))).alias("predicted_class"),
        F.when(~lost, F.get("scores", F.lit(0))).alias("confidence_score"),
        F.when(~lost, F.col("ids")).alias("top_5_classes"),
        F.when(~lost, F.col("scores")).alias("top_5_scores"),
        "file_path",
        F.when(F.col("lost"), f"unusable features in {features}").alias("error"),
    )


def _per_group(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """Named and annotated as Spark wants it, to be given a group batch by batch."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(stream)

    return run

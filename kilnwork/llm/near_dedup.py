"""Near-duplicate detection by BagMinHash.

Each shingle of a text, with its count as weight, owns Poisson processes over dyadic ranges of weight. A register keeps
the earliest point that falls to it at a weight the text reaches; two texts agree in a register with the probability of
their weighted Jaccard similarity. Bands of registers find candidates, whose multisets are then compared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwork.llm.components import components
from kilnwork.llm.memory import release
from kilnwork.llm.shingles import bags, mix, pairwise_similarity
from kilnwork.session import materialise

#: 32 bands of 4 registers: a pair at 0.8 is missed with probability (1 - 0.8^4)^32, under 1e-7.
BANDS, ROWS = 32, 4
THRESHOLD = 0.8


def signatures(texts: Sequence[str], registers: int = BANDS * ROWS) -> np.ndarray:
    """Register values of each text: times of points, or infinity throughout for a text without words.

    The points of a process come in order of time, so a process is followed only up to a time by which all registers
    of its text are very likely filled; texts for which that was too early are done again with twice the time.
    """
    owner, hashes, counts = bags(texts)
    out = np.full((len(texts), registers), np.inf)
    weight = np.bincount(owner, counts, minlength=len(texts))
    limit = (math.log(registers) + 4) / np.maximum(weight, 1)
    todo = weight > 0
    # Range k of an element reaches from 2^(k-1) (0 for k = 0) to 2^k; it takes part if the count goes beyond its start.
    levels = [(owner, hashes, counts, 0.0, 1.0)]
    k = 1
    while (more := counts > 2 ** (k - 1)).any():
        levels.append((owner[more], hashes[more] + np.uint64(k), counts[more], 2.0 ** (k - 1), 2.0 ** (k - 1)))
        k += 1
    while todo.any():
        out[todo] = np.inf
        for own, seed, count, low, length in levels:
            use = todo[own]
            own, seed, count = own[use], mix(seed[use]), count[use]
            time = np.zeros(len(own))
            while len(own):
                seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
                # One mixed value gives the gap (32 bits), the register (16 bits) and the weight (16 bits).
                time = time - np.log(((seed >> np.uint64(32)).astype(np.float64) + 0.5) / 2**32) / (registers * length)
                alive = time <= limit[own]
                own, seed, count, time = own[alive], seed[alive], count[alive], time[alive]
                where = (seed & np.uint64(0xFFFF)) % np.uint64(registers)
                height = low + length * (((seed >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float64) + 0.5) / 2**16
                hit = height < count
                np.minimum.at(out, (own[hit], where[hit].astype(np.int64)), time[hit])
        todo &= ~np.isfinite(out).all(axis=1)
        limit = limit * 2
    return out


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    bits = values.view(np.uint64).reshape(len(values), -1, rows)
    key = np.zeros(bits.shape[:2], np.uint64)
    for r in range(rows):
        key = mix(key + bits[:, :, r])
    return key.view(np.int64)


def sketch(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Key, digest of the text, its bytes and band keys (none without words) of every row, in one pass."""
    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release()
            for part in batches_of(batch):
                texts = part.column("text").to_pylist()
                values = signatures(texts)
                filled = np.isfinite(values[:, 0])
                keys = band_keys(values).ravel()
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(keys), mask=pa.array(~filled))
                coded = [t.encode() for t in texts]
                digests = pa.array([hashlib.md5(c).digest() for c in coded], pa.binary())
                sizes = pa.array([len(c) for c in coded], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), digests, sizes, bands], ["key", "digest", "n_bytes", "bands"])

    return source.mapInArrow(run, "key bigint, digest binary, n_bytes bigint, bands array<bigint>")


def batches_of(batch: pa.RecordBatch, size: int = 2 << 20, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, so that arrays stay small."""
    ends = np.cumsum([len(t or "") + 1 for t in batch.column(column).to_pylist()])
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _links_in_block(table: pa.Table) -> pa.Table:
    """Joins every node of a block to the least node that it reaches through links; only nodes with links."""
    release()
    nodes = table.column("node").to_numpy()
    like = pairwise_similarity(table.column("text").to_pylist()) >= THRESHOLD
    root = nodes.copy()
    while True:  # every node takes the least root among its neighbours, until nothing changes
        seen = np.where(like, root[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(root, seen)
        if (new == root).all():
            break
        root = new
    linked = root != nodes
    return pa.table({"a": nodes[linked], "b": root[linked]})


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", block_rows: int = 1000, block_bytes: int = 8 << 20) -> DataFrame:
    """Key, ``class_id``, ``kept`` and ``text_md5`` for every row: the least key of its class, and whether its own is that.

    Classes are what links of multiset similarity 0.8 or more (five-word shingles) connect, directly or through others.
    Equal texts count once, by the least of their keys. Texts that share a band, directly or through others, form a
    group; within a group every two texts are compared exactly, in blocks of about ``block_rows`` texts of which each
    two meet in a task, so that no link between texts that share a band is lost and a task's memory is bounded.

    A null text counts as empty. Texts without words are only alike if equal. Rows with equal keys are one document.
    Rows with a null key are in the class of their equal texts, and kept if no row with a key has their text; they take
    no part in near matches. Other columns of ``docs`` are ignored.
    """
    rows = materialise(sketch(docs, text, key), "sketches")
    texts = materialise(rows.groupBy("digest").agg(F.min("key").alias("node"), F.first("bands").alias("bands"), F.first("n_bytes").alias("n_bytes")), "texts")
    banded = texts.filter("node is not null and bands is not null").select("node", F.posexplode("bands").alias("band", "value"))
    least = banded.groupBy("band", "value").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1").select("band", "value", "least")
    stars = banded.join(materialise(least, "buckets"), ["band", "value"]).filter("node <> least")
    candidates = materialise(stars.groupBy("node", "least").agg(F.lit(1)).select(F.col("node").alias("a"), F.col("least").alias("b")), "candidates")

    groups = components(candidates).withColumnRenamed("root", "group")
    sized = materialise(groups.join(texts.filter("node is not null").groupBy("node").agg(F.max("n_bytes").alias("n_bytes")), "node"), "groups")
    n_blocks = F.ceil(F.greatest(F.count("*") / block_rows, F.sum("n_bytes") / block_bytes)).cast("int")
    blocks = materialise(sized.groupBy("group").agg(n_blocks.alias("n")), "blocks")
    block = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    placed = sized.join(blocks, "group").select("node", "group", "n", block.alias("block"))
    chosen = docs.select(F.col(key).cast("long").alias("node"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = chosen.join(placed, "node").select(
        "node", "text", "group", "block",
        # Every other block meets this one once; a group of one block is compared with itself.
        F.explode(F.when(F.col("n") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("n") - 1), F.col("block")))).alias("other"),
    )
    met = placed.select("node", "text", "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    links = materialise(met.groupBy("group", "i", "j").applyInArrow(_links_in_block, "a bigint, b bigint"), "links")

    classes = components(links)
    named = texts.join(classes, "node", "left").select(F.col("digest"), F.coalesce("root", "node").alias("class_id"))
    out = rows.join(materialise(named, "classes"), "digest")
    kept = F.col("key").eqNullSafe(F.col("class_id"))
    return out.select(F.col("key").alias(key), "class_id", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_md5"))

"""Document fingerprints by a threshold-scaled sketch, with DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, and all hashes of a text of few shingles,
beside the exact number of different shingles. Its size follows the text, sketches of parts
merge by union, and containment can be estimated between texts of very unequal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilnwork.llm.rules import WORD_BREAK

SHINGLE_WORDS = 5
#: One hash in four is kept: a text of 60 words then has about 14.
FRACTION = 0.25
#: A text of fewer different shingles keeps them all.
WHOLE_BELOW = 64


def _limit(fraction: float) -> int:
    """Signed 64-bit hashes below this are kept."""
    return int(-(2**63) + fraction * 2**64) if fraction < 1 else 2**63 - 1


def with_sketch(df: DataFrame, text: str, name: str, fraction: float = FRACTION, words: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` with ``name``, the sorted distinct kept hashes of the text's shingles, and ``<name>_n``, the number of all.

    With fewer than ``WHOLE_BELOW`` all are kept. A text of fewer words than a shingle has one shingle, all its words. A
    text without words, or null, has none.
    """
    # inline() keeps the words as a value: as a plain projection they would be split anew for every shingle.
    split = df.select(
        "*", F.inline(F.array(F.struct(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "").alias("_words"))))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words") - (words - 1), F.lit(1)))
    hashes = F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, words))))
    none = F.array().cast("array<bigint>")
    own = F.when(F.size("_words") > 0, hashes).otherwise(none)
    every = split.select(*df.columns, F.inline(F.array(F.struct(own.alias("_all")))))
    kept = F.when(F.size("_all") < WHOLE_BELOW, F.col("_all")).otherwise(_below(F.col("_all"), fraction))
    return every.withColumns({name: F.array_sort(kept), f"{name}_n": F.size("_all")}).drop("_all")


def _below(sketch: str | Column, fraction: float) -> Column:
    return F.filter(sketch, lambda h: h <= F.lit(_limit(fraction)))


def _both_whole(n_a: str | None, n_b: str | None) -> Column:
    if n_a is None or n_b is None:
        return F.lit(False)
    return (F.col(n_a) < WHOLE_BELOW) & (F.col(n_b) < WHOLE_BELOW)


def _comparable(a: str, b: str, n_a: str | None, n_b: str | None, fraction: float) -> tuple[Column, Column]:
    """Both sketches whole, where both are, or else both filtered by the fraction."""
    whole = _both_whole(n_a, n_b)
    return tuple(F.when(whole, F.col(c)).otherwise(_below(c, fraction)) for c in (a, b))


def merged(a: str, b: str, n_a: str | None = None, n_b: str | None = None, fraction: float = FRACTION) -> Column:
    """The sketch of two texts taken together; without numbers of shingles, as of larger texts."""
    both = F.array_union(a, b)
    whole = _both_whole(n_a, n_b) & (F.size(both) < WHOLE_BELOW)
    return F.array_sort(F.when(whole, both).otherwise(_below(both, fraction)))


def containment(a: str, b: str, n_a: str | None = None, n_b: str | None = None, fraction: float = FRACTION) -> Column:
    """Share of the shingles of ``a`` that ``b`` holds, exact for two whole sketches; null if ``a`` has none kept."""
    x, y = _comparable(a, b, n_a, n_b, fraction)
    return F.size(F.array_intersect(x, y)) / F.nullif(F.size(x), F.lit(0))


def likeness(a: str, b: str, n_a: str | None = None, n_b: str | None = None, fraction: float = FRACTION) -> Column:
    """Jaccard similarity, 0 to 1: exact for two whole sketches, else estimated.

    Two texts without shingles are alike (1). Where no hash is kept otherwise, only equal sketches are.
    """
    x, y = _comparable(a, b, n_a, n_b, fraction)
    both = F.size(F.array_intersect(x, y))
    either = F.size(x) + F.size(y) - both
    same = F.col(a) == F.col(b)
    if n_a is not None and n_b is not None:
        same &= (F.col(n_a) < WHOLE_BELOW) & (F.col(n_b) < WHOLE_BELOW)
    return F.when(either == 0, same.cast("double")).otherwise(both / F.greatest(either, F.lit(1))).cast("double")


def as_text(sketch: str) -> Column:
    """The sketch as lowercase hex, 16 digits a hash, joined by dots."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ".")


def with_next(df: DataFrame, key: str, following: dict[str, str], blocks: int | None = None) -> DataFrame:
    """``df`` with columns of the next row in ascending ``key``; after the last row comes the first.

    ``following`` maps new names to columns. Rows are cut into blocks at quantiles of the key, so that only one row of
    each block meets the others. Null keys come first; rows with equal keys are ordered by their columns' hash.
    """
    spark = df.sparkSession
    blocks = blocks or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(key, [i / blocks for i in range(1, blocks)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    block = F.lit(0)
    if cuts:
        bounds = F.array(*(F.lit(c) for c in cuts))
        block = F.coalesce(F.size(F.filter(bounds, lambda c: c < F.col(key))), F.lit(-1))
    tie = F.xxhash64(*following.values())
    order = [F.col(key).asc_nulls_first(), tie]
    cut = df.withColumn("_block", block)
    inside = Window.partitionBy("_block").orderBy(*order)
    led = cut.withColumns({"_last": F.lead(F.lit(False), 1, True).over(inside)} | {n: F.lead(c).over(inside) for n, c in following.items()})
    # The first row of each block: as many rows as blocks, so one task may order them.
    heads = cut.groupBy("_block").agg(
        F.min_by(F.struct(*(F.col(c).alias(n) for n, c in following.items())), F.struct(F.col(key).isNotNull(), key, tie)).alias("_head")
    )
    whole = Window.orderBy("_block")
    first = F.first("_head").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_block", F.coalesce(F.lead("_head").over(whole), first).alias("_head"))
    joined = led.join(heads, "_block")
    for n in following:
        joined = joined.withColumn(n, F.when(F.col("_last"), F.col("_head")[n]).otherwise(F.col(n)))
    return joined.drop("_block", "_last", "_head")


def fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id", fraction: float = FRACTION) -> DataFrame:
    """Key, ``n_chars``, whole text, ``sketch`` and ``sketch_n`` of every row; a null text counts as empty."""
    base = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_sketch(base, "text", "sketch", fraction).withColumn("n_chars", F.length("text").cast("long"))


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every text and of its edit, with the likeness to the edit and to the next document.

    The edit replaces the last quarter of the code points (rounded down) by the first as many of the next document in
    ascending key, or all of it if it is shorter; after the last document comes the first.
    """
    sketched = fingerprint(docs, text, key, fraction)
    paired = with_next(sketched, key, {"next_text": "text", "next_sketch": "sketch", "next_n": "sketch_n"})
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.substring("next_text", F.lit(1), quarter)
    )
    paired = paired.withColumn("edited", edited).drop("text", "next_text")
    out = with_sketch(paired, "edited", "edited_sketch", fraction)
    return out.select(
        key,
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.col("sketch_n").alias("n_shingles"),
        as_text("sketch").alias("fingerprint"),
        F.col("edited_sketch_n").alias("edited_n_shingles"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch", "sketch_n", "edited_sketch_n", fraction).alias("near_edited"),
        likeness("sketch", "next_sketch", "sketch_n", "next_n", fraction).alias("near_next"),
    )

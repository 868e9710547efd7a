"""Language identification by fusing evidence with Bayes' rule.

The likelihood of a text under each language (hashed letter trigrams) meets three priors: the declared markup language
with its measured reliability, the address suffix, and the host. Counts of a host are smoothed with those of its suffix,
and those of a suffix with those of the whole corpus; all come from one grouped aggregation over every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.llm.memory import release
from kilnwork.session import materialise

BUCKETS = 1 << 14
UNKNOWN = "und"
#: Trigrams overlap, so each byte is counted three times.
_OVERLAP = 3.0
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class TextModel:
    """``logp[l, b]``: log-probability of trigram bucket ``b`` in language ``l``; the last row is unknown (uniform)."""

    languages: tuple[str, ...]
    logp: np.ndarray


def parts_of(texts: pa.Array, size: int = 1 << 18) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters (a longer text is a run by itself); only one is taken out of the batch at a time."""
    at = held = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if i > at and held + n > size:
            yield [t or "" for t in texts.slice(at, i - at).to_pylist()]
            at, held = i, 0
        held += n
    yield [t or "" for t in texts.slice(at).to_pylist()]


def _joined(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The lower-case bytes of texts between separators of three bytes, and how many bytes each has."""
    lowered = [t.lower().encode() for t in texts]
    return np.frombuffer(b"\n \n".join([b"", *lowered, b""]), np.uint8), np.array([len(t) for t in lowered], np.int64)


def _buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of bytes, and which first bytes they have."""
    letters = _LETTERS[data].astype(np.uint32)
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    keep = (b != 32) & ((a != 32) | (c != 32))
    hashed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))
    return ((hashed * np.uint32(0x27D4EB2F)) >> np.uint32(18))[keep].astype(np.int64), keep


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts in a row, and where each text's begin (one more offset than texts).

    Letters are lower case; everything else is a gap, and trigrams around a gap's middle are left out.
    """
    data, sizes = _joined(texts)
    if len(data) < 3:
        return np.empty(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
    buckets, keep = _buckets(data)
    # Text i begins after i + 1 separators of three bytes; trigrams are numbered by their first byte.
    starts = 3 * np.arange(1, len(sizes) + 1) + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.empty(0, np.int64)
    bounds = np.concatenate([np.maximum(starts - 1, 0), [len(keep)]])
    before = np.concatenate([[0], np.cumsum(keep)])
    return buckets, before[bounds]


def trigram_runs(texts: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts as the place of the first one and their :func:`trigrams`; a long text comes as several runs of its parts."""
    at = 0
    for part in parts_of(texts, size):
        if len(part) == 1 and len(part[0]) > size:
            data, _ = _joined(part)
            for since in range(0, len(data) - 2, size):
                buckets, _ = _buckets(data[since : since + size + 2])
                yield at, buckets, np.array([0, len(buckets)])
        else:
            yield at, *trigrams(part)
        at += len(part)


def fit_text_model(
    docs: DataFrame,
    languages: Sequence[str] = ("en", "de", "fr", "es"),
    text: str = "text",
    label: str = "lang",
) -> TextModel:
    """Trigram counts of every labelled row.

    Rows with another label or none are not used. A language without rows is uniform.
    """
    labelled = docs.filter(F.col(label).isin(*languages)).select(F.col(label).alias("l"), F.col(text).alias("t"))
    wanted = tuple(languages)

    def count(batches):
        sums = np.zeros((len(wanted), BUCKETS), np.int64)
        for batch in batches:
            release()
            which = np.array([wanted.index(x) for x in batch.column("l").to_pylist()], np.int64)
            for first, buckets, bounds in trigram_runs(batch.column("t")):
                rows_of = np.repeat(which[first : first + len(bounds) - 1], np.diff(bounds))
                sums += np.bincount(rows_of * BUCKETS + buckets, minlength=sums.size).reshape(sums.shape)
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums.ravel()[cells])], ["cell", "n"])

    # A task has one row for each language and bucket at most, and so has the driver, however many tasks there are.
    counted = labelled.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((len(wanted), BUCKETS))
    total.ravel()[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    smooth = total + 0.5
    logp = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return TextModel(wanted, np.vstack([logp, np.full(BUCKETS, -math.log(BUCKETS))]).astype(np.float32))


def text_scores(model: TextModel, text: str) -> Column:
    """Log-likelihood of the text under each language and under unknown; null without letters."""
    logp = model.logp

    @F.arrow_udf("array<float>")
    def scores(texts: pa.Array) -> pa.Array:
        release()
        if not len(texts):
            return pa.array([], pa.list_(pa.float32()))
        sums, sizes = np.zeros((len(texts), len(logp))), np.zeros(len(texts), np.int64)
        for first, buckets, bounds in trigram_runs(texts):
            running = np.zeros((len(logp), len(buckets) + 1))
            np.cumsum(logp[:, buckets], axis=1, dtype=np.float64, out=running[:, 1:])
            sums[first : first + len(bounds) - 1] += (running[:, bounds[1:]] - running[:, bounds[:-1]]).T
            sizes[first : first + len(bounds) - 1] += np.diff(bounds)
        flat = pa.array((sums / _OVERLAP).ravel().astype(np.float32))
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(logp))
        return pa.ListArray.from_arrays(offsets, flat, mask=pa.array(sizes == 0))

    return scores(F.col(text))


def address_suffix(host: Column) -> Column:
    """Last label of a host name."""
    return F.lower(F.substring_index(host, ".", -1))


def identify(
    docs: DataFrame,
    model: TextModel,
    text: str = "text",
    declared: str | None = "lang",
    host: str | None = "source",
    suffix: Column | None = None,
    strength: float = 20.0,
    threshold: float = 0.5,
    into: str = "lid",
) -> DataFrame:
    """``docs`` with a struct ``into``: language, probability, text_language and kept.

    A row is kept if its language is one of the model's with at least ``threshold`` probability. A text without
    letters, empty or null is ``und`` with probability 1 and not kept; so is a text that is likelier under evenly
    spread trigrams than under any language. Null or undeclared languages, hosts and suffixes are values of their own;
    rows with equal columns get equal results, and every other column passes through (one named ``into`` is replaced).
    ``strength``: how many rows' worth the smoothing counts.
    """
    names = [*model.languages, UNKNOWN]
    n = len(names)
    none = F.lit(None).cast("string")
    declared_at = F.coalesce(
        F.nullif(F.array_position(F.array(*map(F.lit, model.languages)), F.lower(F.col(declared).cast("string")) if declared else none), F.lit(0)) - 1,
        F.lit(n - 1),
    ).cast("int")
    scored = docs.withColumn("_scores", text_scores(model, text)).withColumns(
        {
            "_declared": declared_at,
            "_host": F.col(host).cast("string") if host else none,
            "_suffix": suffix.cast("string") if suffix is not None else none,
            "_best": (F.array_position("_scores", F.array_max("_scores")) - 1).cast("int"),
        }
    )
    counted = scored.groupBy("_host", "_suffix", "_declared", "_best").agg(F.count("*").alias("n"))
    # Texts without letters go after the counting: a filter before it would score every text twice, in two workers a task.
    counted = materialise(counted, "languages").filter("_best is not null")

    def tally(*by: str) -> DataFrame:
        sums = (F.coalesce(F.sum(F.when(F.col("_best") == i, F.col("n"))), F.lit(0)).cast("double") for i in range(n))
        return counted.groupBy(*by).agg(F.array(*sums).alias("_n"))

    def smoothed(counts: str, towards: Column) -> Column:
        whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) + strength
        return F.zip_with(counts, towards, lambda c, p: (c + strength * p) / whole)

    whole = tally().first()["_n"]
    overall = [(c + 1) / (sum(whole) + n) for c in whole]
    prior = F.array(*map(F.lit, overall))
    # How often each language is declared as each other: at most n x n rows.
    seen = [[1.0] * n for _ in range(n)]
    for row in counted.groupBy("_declared", "_best").agg(F.sum("n").alias("n")).collect():
        seen[row["_declared"]][row["_best"]] += row["n"]
    of_language = [sum(seen[d][i] for d in range(n)) for i in range(n)]
    reliability = F.array(*(F.array(*(F.lit(math.log(seen[d][i] / of_language[i])) for i in range(n))) for d in range(n)))

    by_suffix = tally("_suffix").select(F.col("_suffix").alias("_s"), smoothed("_n", prior).alias("_suffix_prior"))
    by_host = tally("_host", "_suffix").join(by_suffix, F.col("_suffix").eqNullSafe(F.col("_s")))
    by_host = by_host.select(F.col("_host").alias("_h"), F.col("_suffix").alias("_s"), smoothed("_n", F.col("_suffix_prior")).alias("_prior"))
    by_host = materialise(by_host, "hosts")

    # Hosts with a third of all rows are split by skew handling if the table of hosts is too large to send.
    joined = scored.join(by_host, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_suffix").eqNullSafe(F.col("_s")), "left")
    logs = F.zip_with(
        F.zip_with("_scores", F.coalesce("_prior", prior), lambda s, p: s.cast("double") + F.log(p)),
        reliability[F.col("_declared")],
        lambda a, b: a + b,
    )
    joined = joined.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    total = F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    at = F.array_position("_logs", F.col("_top")).cast("int") - 1
    listed = F.array(*map(F.lit, names))
    known = F.col("_scores").isNotNull()
    language = F.when(known, listed[at]).otherwise(UNKNOWN)
    probability = F.when(known, 1 / total).otherwise(1.0)
    result = F.struct(
        language.alias("language"),
        probability.alias("probability"),
        F.when(known, listed[F.col("_best")]).otherwise(UNKNOWN).alias("text_language"),
        ((language != UNKNOWN) & (probability >= threshold)).alias("kept"),
    )
    return joined.withColumn(into, result).select(*(c for c in docs.columns if c != into), into)

"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every text. Expectation-maximisation estimates how each of them votes on good and
on bad texts; the posteriors of a sample are the labels of a linear scorer over hashed features, which sees the
text itself and so also judges where the labellers abstain.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwork.llm.near_dedup import batches_of
from kilnwork.llm.rules import ABSTAIN, RULES, Rule, VoteModel, fit_votes, text_counts
from kilnwork.llm.shingles import mix, shingle_hashes

BUCKETS = 1 << 16
_REPEAT_BINS = 16


@dataclass(frozen=True)
class Scorer:
    """``weights``: one for each feature bucket; ``bias`` is added."""

    weights: np.ndarray
    bias: float

    def score(self, texts: Sequence[str]) -> np.ndarray:
        owner, bucket, value = features(texts)
        sums = np.bincount(owner, self.weights[bucket] * value, minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -50, 50)))


def features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and value of the features of each text.

    Byte trigrams, hashed, with the square root of their share; and one for the share of 3-word windows that repeat.
    """
    coded = [t.encode() for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    grams = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    inside = owner[2:] == owner[:-2]
    grams, owner = mix(grams[inside]) % np.uint64(BUCKETS - _REPEAT_BINS), owner[:-2][inside]
    keys, counts = np.unique(owner.astype(np.uint64) * np.uint64(BUCKETS) + grams, return_counts=True)
    owner, bucket = (keys // np.uint64(BUCKETS)).astype(np.int64), (keys % np.uint64(BUCKETS)).astype(np.int64)
    total = np.bincount(owner, counts, minlength=len(texts))
    value = np.sqrt(counts / np.maximum(total[owner], 1))

    window, of = shingle_hashes(texts, 3)
    distinct = np.unique(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ window, return_index=True)[1]
    n = np.bincount(of, minlength=len(texts))
    repeated = 1 - np.bincount(of[distinct], minlength=len(texts)) / np.maximum(n, 1)
    bins = BUCKETS - _REPEAT_BINS + np.minimum((repeated * _REPEAT_BINS).astype(np.int64), _REPEAT_BINS - 1)
    return np.concatenate([owner, np.arange(len(texts))]), np.concatenate([bucket, bins]), np.concatenate([value, np.ones(len(texts))])


def fit_scorer(rows: Sequence[tuple[np.ndarray, np.ndarray, float]], epochs: int = 30, rate: float = 1.0, shrink: float = 1e-6) -> Scorer:
    """Logistic regression with soft labels by AdaGrad over (buckets, values, label) of each text, in their order."""
    weights, bias = np.zeros(BUCKETS), 0.0
    seen, seen_bias = np.full(BUCKETS, 1e-8), 1e-8
    step = 64
    for _ in range(epochs):
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            owner = np.repeat(np.arange(len(part)), [len(r[0]) for r in part])
            bucket, value = np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part])
            label = np.array([r[2] for r in part])
            sums = np.bincount(owner, weights[bucket] * value, minlength=len(part)) + bias
            error = (1 / (1 + np.exp(-np.clip(sums, -50, 50))) - label) / len(part)
            used, back = np.unique(bucket, return_inverse=True)
            slope = np.bincount(back, error[owner] * value) + shrink * weights[used]
            seen[used] += slope**2
            weights[used] -= rate * slope / np.sqrt(seen[used])
            seen_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(seen_bias)
    return Scorer(weights.astype(np.float32), float(bias))


def fit(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 8_000
) -> tuple[VoteModel, Scorer]:
    """The label model, from the votes on every row, and the scorer, from about ``sample_rows`` of them chosen by hash.

    The sample's features come to the driver (some 5 KB a row); the vote patterns are at most 3^rules. Texts without
    words have no part in either.
    """
    names = [f"vote_{r.name}" for r in rules]

    def voted(df: DataFrame, keep: Sequence[str]) -> DataFrame:
        counted = text_counts(df, text, keep).filter("n_words > 0")
        return counted.withColumns({n: F.coalesce(r.vote(), F.lit(ABSTAIN)) for n, r in zip(names, rules, strict=True)})

    source = docs.select(F.col(text))
    counts = voted(source, []).groupBy(*names).count().collect()
    patterns = {tuple(r[n] for n in names): r["count"] for r in counts}
    model = fit_votes(patterns)
    if not patterns:
        return model, Scorer(np.zeros(BUCKETS, np.float32), 0.0)
    share = min(1.0, sample_rows / sum(patterns.values()))
    # By the whole row, so that copies of a text are not drawn as one.
    chosen = docs.filter(F.pmod(F.xxhash64(*docs.columns, F.lit("fit")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(text)
    odds = model.log_odds([F.col(n) for n in names])
    labelled = voted(chosen, [text]).select(F.col(text).alias("text"), (1 / (1 + F.exp(-odds))).alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch):
                owner, bucket, value = features(part.column("text").to_pylist())
                order = np.argsort(owner, kind="stable")
                ends = np.cumsum(np.bincount(owner, minlength=part.num_rows))[:-1]
                packed = [
                    [c.tobytes() for c in np.split(column[order], ends)]
                    for column in (bucket.astype("<i4"), value.astype("<f4"))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(packed[0]), pa.array(packed[1]), part.column("label")], ["b", "v", "label"])

    got = labelled.mapInArrow(run, "b binary, v binary, label double").collect()
    rows = [(np.frombuffer(r["b"], "<i4"), np.frombuffer(r["v"], "<f4"), r["label"]) for r in got]
    rows.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[1].tobytes()))  # the same order however Spark returns them
    order = np.random.default_rng(7).permutation(len(rows))
    return model, fit_scorer([rows[i] for i in order])


def score(
    docs: DataFrame, scorer: Scorer, text: str = "text", keep: Sequence[str] = ("doc_id",), threshold: float = 0.5
) -> DataFrame:
    """``keep`` columns with ``quality`` (0 to 1) and ``kept`` for every row.

    Texts without words, empty or null, have quality 0 and are not kept. Equal texts get equal results.
    """
    weights, bias = scorer.weights, scorer.bias

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        own = Scorer(weights, bias)
        table = pa.RecordBatch.from_arrays([texts], ["text"])
        out = [np.empty(0)]
        for part in batches_of(table):
            values = [t or "" for t in part.column("text").to_pylist()]
            out.append(np.where([bool(v.strip(" \t\n\x0b\x0c\r")) for v in values], own.score(values), 0.0))
        return pa.array(np.concatenate(out))

    rows = docs.select(*keep, quality(F.col(text)).alias("quality"))
    return rows.withColumn("kept", F.col("quality") >= threshold)

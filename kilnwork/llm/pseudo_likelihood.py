"""Language-model scoring by masked pseudo-likelihood.

A window network reads two words on either side of a masked word and predicts it: embeddings, one hidden layer, and a
softmax in two steps (class of words, then word of the class). The most frequent words are classes of their own; the
others are predicted as one unknown word and told apart by their own counts. Word counts come from the whole corpus; the network is
trained in NumPy by the tasks of Spark, each on its own documents, and their parameters are averaged after every round.
A document's score is the sum of the log-probabilities of all its words.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.llm.near_dedup import batches_of
from kilnwork.llm.shingles import ODD, mix
from kilnwork.session import materialise

SIDE = 2
CLASSES, MEMBERS = 64, 64
EMBEDDING, HIDDEN = 12, 24
UNKNOWN, PAD = 0, CLASSES * MEMBERS
#: Ids of unknown words as context, by hash, follow ``PAD``.
BUCKETS = 1 << 12
_SHAPES = {
    "embedding": (PAD + 1 + BUCKETS, EMBEDDING),
    "into": (2 * SIDE * EMBEDDING, HIDDEN),
    "into_bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (CLASSES, HIDDEN, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
}


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Longer words are hashed one by one.
_SHORT = 64


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts in a row, by eight bytes at a time, and the text it belongs to."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    raw = b"\n".join([b"", *coded, b"\0" * 8])
    gap = _SPACE[np.frombuffer(raw, np.uint8)[: len(raw) - 8]]
    edge = np.flatnonzero(gap[:-1] != gap[1:]) + 1
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    hashes = mix((eights[starts] & masks[np.minimum(sizes, 8)]) + ODD)
    for k in range(8, _SHORT, 8):
        more = np.flatnonzero(sizes > k)
        if not len(more):
            break
        hashes[more] = mix(hashes[more] * ODD + (eights[starts[more] + k] & masks[np.minimum(sizes[more] - k, 8)]))
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest(), "little")
    bounds = np.cumsum([len(c) + 1 for c in coded], dtype=np.int64)
    return hashes, np.searchsorted(bounds, starts - 1, side="right")


class SortedHashes:
    """Ascending 64-bit hashes, found by their first bits."""

    def __init__(self, hashes: np.ndarray):
        self.size = len(hashes)
        self.hashes = np.append(hashes, np.uint64(2**64 - 1)).astype(np.uint64)
        bits = max(1, (2 * self.size).bit_length())
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.first = (np.cumsum(sizes) - sizes).astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash is, and whether it is there."""
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        there = self.hashes[at]
        behind = np.flatnonzero(there < hashes)
        while len(behind):
            at[behind] += 1
            there[behind] = self.hashes[at[behind]]
            behind = behind[there[behind] < hashes[behind]]
        return at, (there == hashes) & (at < self.size)


@dataclass(frozen=True)
class Vocabulary:
    """Hashes of the most frequent words in ascending order, their ids by falling count (from 1), and counts by id."""

    hashes: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    #: Different words beyond these.
    others: int
    #: Table of all words' hashes and counts; stays on the driver.
    words: DataFrame | None = None
    #: Hashes in ascending order and counts of frequent words, at most ``_COMMON``; the table has them as well.
    common: tuple[np.ndarray, np.ndarray] | None = None

    @cached_property
    def _sorted(self) -> SortedHashes:
        return SortedHashes(self.hashes)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        at, found = self._sorted.find(hashes)
        return np.where(found, np.append(self.ids, UNKNOWN)[at], UNKNOWN)

    def for_tasks(self) -> Vocabulary:
        return replace(self, words=None, common=None)


#: Words whose counts every task has; those of all others are joined.
_COMMON = 1 << 18


def fit_vocabulary(docs: DataFrame, text: str = "text") -> Vocabulary:
    """Counts the words of every row; the ``CLASSES * MEMBERS - 1`` most frequent come to the driver, all stay in a table.

    Counts of further words come along, from the largest down to a size of count that keeps them within ``_COMMON``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, 8 << 20):
                values, n = np.unique(word_hashes([t or "" for t in part.column("text").to_pylist()])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["word", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "words")
    size = F.floor(F.log2("n") * 8)  # an eighth of a doubling each, so few whatever the corpus
    sizes = sorted(counted.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect(), reverse=True)
    within = [r["size"] for r, words in zip(sizes, itertools.accumulate(r["words"] for r in sizes), strict=True) if words <= _COMMON]
    frequent = counted.filter(size >= F.lit(within[-1] if within else 1 << 20)).toArrow()
    frequent_hashes = frequent.column("word").to_numpy().view(np.uint64)
    ascending = np.argsort(frequent_hashes)
    common = (frequent_hashes[ascending], frequent.column("n").to_numpy()[ascending])
    top = counted.orderBy(F.desc("n"), "word").limit(CLASSES * MEMBERS - 1).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    counts = np.zeros(PAD)
    counts[1 : len(top) + 1] = [r["n"] for r in top]
    counts[UNKNOWN] = sum(r["tokens"] for r in sizes) - counts.sum()
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order + 1, counts, sum(r["words"] for r in sizes) - len(top), counted, common)


def start(vocabulary: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; biases that already give every word its share of the corpus."""
    random = np.random.default_rng(seed)
    net = {n: (random.standard_normal(s) * (s[-2] if len(s) > 1 else 1) ** -0.5).astype(np.float32) for n, s in _SHAPES.items()}
    net["embedding"] *= 3.0
    net["members"] *= 0.1
    net["classes"] *= 0.1
    share = np.log((vocabulary.counts + 0.5).reshape(CLASSES, MEMBERS))
    net["member_bias"] = share.astype(np.float32)
    net["class_bias"] = np.log(np.exp(share).sum(axis=1)).astype(np.float32)
    net["into_bias"] *= 0
    return net


def context_ids(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Ids of words as context: an unknown word has that of its bucket."""
    return np.where(ids == UNKNOWN, PAD + 1 + (hashes % np.uint64(BUCKETS)).astype(np.int64), ids)


def contexts(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Ids of the words before and after each word within its text; ``PAD`` beyond its ends."""
    n = len(ids)
    out = np.full((n, 2 * SIDE), PAD, ids.dtype)
    for k in range(1, SIDE + 1):
        if n > k:
            same = owner[k:] == owner[:-k]
            out[k:, SIDE - k] = np.where(same, ids[:-k], PAD)
            out[:-k, SIDE + k - 1] = np.where(same, ids[k:], PAD)
    return out


#: Logits that lie closer together than this need no row's own maximum: their exponentials stay normal numbers.
_RANGE = 80.0


def _tops(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """What no logit of each layer exceeds, as hidden values are between -1 and 1; NaN if logits may lie too far apart."""
    reach = np.abs(weights).sum(axis=-2)
    top = (bias + reach).max(axis=-1)
    return np.where(top - (bias - reach).min(axis=-1) < _RANGE, top, np.nan)


#: Rows whose logits are held at a time, so that they stay in the processor's cache.
_BLOCK = 2048
_ONES = np.ones(max(CLASSES, MEMBERS), np.float32)


def _layer(weights: np.ndarray, bias: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Weights with the bias as last row; logits lie around 0 by it unless ``top`` is NaN."""
    with_bias = np.concatenate([weights, bias[..., None, :]], axis=-2)
    with_bias[..., -1, :] -= np.where(np.isnan(top), 0, top - _RANGE / 2).astype(np.float32)[..., None]
    return with_bias


def _powers(hidden: np.ndarray, layer: np.ndarray, top: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials of a block's logits, their sums by row, and of one entry of each row its place and logit."""
    logits = hidden @ layer
    if np.isnan(top):
        logits -= logits.max(axis=1, keepdims=True)
    places = np.arange(0, logits.size, logits.shape[1])
    places += chosen
    picked = logits.reshape(-1)[places]
    np.exp(logits, out=logits)
    return logits, logits @ _ONES[: logits.shape[1]], places, picked


def _learn(hidden: np.ndarray, layer: np.ndarray, top: np.ndarray, chosen: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Adds a softmax's slope at its inputs to ``back`` and returns that of its weights with the bias."""
    powers, sums, places, _ = _powers(hidden, layer, top, chosen)
    powers.reshape(-1)[places] -= sums
    shares = (1 / sums)[:, None]
    back += (powers @ layer[:-1].T) * shares
    return (hidden * shares).T @ powers


def _log_share(hidden: np.ndarray, layer: np.ndarray, top: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of one entry of each row."""
    _, sums, _, picked = _powers(hidden, layer, top, chosen)
    return picked - np.log(sums)


def _hidden(net: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and hidden values of some windows; the latter with a last column of ones, for the bias."""
    inputs = np.take(net["embedding"], around, axis=0).reshape(len(around), -1)
    values = inputs @ net["into"]
    values += net["into_bias"]
    hidden = np.ones((len(around), HIDDEN + 1), np.float32)
    np.tanh(values, out=hidden[:, :HIDDEN])
    return inputs, hidden


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """An order of words by class, and in it their classes, their members and each class's places in blocks."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    group, member = np.divmod(ids[order], MEMBERS)
    bounds = np.searchsorted(group, np.arange(CLASSES + 1)).tolist()
    return order, group, member, [(c, use) for c in range(CLASSES) for use in _blocks(bounds[c], bounds[c + 1])]


def _blocks(since: int, till: int) -> list[slice]:
    return [slice(at, min(at + _BLOCK, till)) for at in range(since, till, _BLOCK)]


def log_probabilities(net: dict[str, np.ndarray], ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Log-probability of each word given the words around it."""
    out = np.empty(len(ids))
    class_top, tops = _tops(net["classes"], net["class_bias"]), _tops(net["members"], net["member_bias"])
    classes, members = _layer(net["classes"], net["class_bias"], class_top), _layer(net["members"], net["member_bias"], tops)
    for at in range(0, len(ids), 1 << 14):
        order, group, member, uses = _by_class(ids[at : at + (1 << 14)])
        _, hidden = _hidden(net, np.take(around[at : at + (1 << 14)], order, axis=0))
        logs = np.empty(len(order))
        for use in _blocks(0, len(order)):
            logs[use] = _log_share(hidden[use], classes, class_top, group[use])
        for c, use in uses:
            logs[use] += _log_share(hidden[use], members[c], tops[c], member[use])
        out[at + order] = logs
    return out


def train(net: dict[str, np.ndarray], batches: Iterator[tuple[np.ndarray, np.ndarray]], rate: float = 0.05) -> int:
    """One AdaGrad step for each (ids, contexts); changes ``net`` and returns how many words it saw."""
    seen = {n: np.full(v.shape, 1e-6, np.float32) for n, v in net.items()}
    total = 0
    for ids, around in batches:
        n = len(ids)
        if not n:
            continue
        total += n
        order, group, member, uses = _by_class(ids)
        around = np.take(around, order, axis=0)
        inputs, hidden = _hidden(net, around)
        class_top, tops = _tops(net["classes"], net["class_bias"]), _tops(net["members"], net["member_bias"])
        classes, members = _layer(net["classes"], net["class_bias"], class_top), _layer(net["members"], net["member_bias"], tops)
        of_classes, of_members, back = np.zeros_like(classes), np.zeros_like(members), np.zeros((n, HIDDEN), np.float32)
        for use in _blocks(0, n):
            of_classes += _learn(hidden[use], classes, class_top, group[use], back[use])
        for c, use in uses:
            of_members[c] += _learn(hidden[use], members[c], tops[c], member[use], back[use])
        back *= 1 - hidden[:, :HIDDEN] ** 2
        slopes = {
            "classes": of_classes[:-1],
            "class_bias": of_classes[-1],
            "members": of_members[:, :-1],
            "member_bias": of_members[:, -1],
            "into": inputs.T @ back,
            "into_bias": np.ones(n, np.float32) @ back,
        }
        # Each word's embedding moves by the sum over its places.
        places = around.T.ravel().astype(np.intp)
        words = np.flatnonzero(np.bincount(places))
        pulls = (net["into"] @ back.T).reshape(2 * SIDE, EMBEDDING, n)
        moved = np.stack([np.bincount(places, pulls[:, d].ravel())[words] for d in range(EMBEDDING)], axis=1).astype(np.float32) / n
        for name, slope in slopes.items():
            slope = slope / n
            seen[name] += slope**2
            net[name] -= rate * slope / np.sqrt(seen[name])
        so_far = np.take(seen["embedding"], words, axis=0) + moved**2
        seen["embedding"][words] = so_far
        net["embedding"][words] -= rate * moved / np.sqrt(so_far)
    return total


def _flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[n].ravel() for n in _SHAPES])


def _unflat(flat: np.ndarray) -> dict[str, np.ndarray]:
    net, at = {}, 0
    for name, shape in _SHAPES.items():
        size = math.prod(shape)
        net[name] = flat[at : at + size].reshape(shape).copy()
        at += size
    return net


_DRAWS = 1 << 20


def _in_round(draw: Column, i: int, share: float) -> Column:
    """Is a draw below ``_DRAWS`` in the ``i``-th ``share`` of them? After the last share comes the first again."""
    since, till = round(i * share * _DRAWS), round((i + 1) * share * _DRAWS)
    return F.pmod(draw - F.lit(since), F.lit(_DRAWS)) < F.lit(till - since)


#: Words that one shard trains on, one after the other, and words that are mixed at a time.
_SHARD_WORDS, _MIXED = 1 << 21, 1 << 18
#: Tasks that the shards of a round are dealt to at most.
_MOST_TASKS = 1 << 14
#: Parameters that one task adds up.
_FAN_IN = 64


def fit(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", share: float = 0.25, rounds: int = 4, step: int = 8192
) -> dict[str, np.ndarray]:
    """Trains on every row once, unless told otherwise: each round on the next ``share`` of the rows by hash.

    A round's rows are dealt by hash into shards of about two million words, whose number follows the corpus. Each shard
    trains from the round's parameters, in the order of its rows' hashes; the average weighted by words starts the next
    round. So the parameters do not depend on how the rows are partitioned. The hash is that of the whole row without
    maps, so that copies of a text are dealt over the rounds and shards; rows equal in all columns go together.
    """
    spark = docs.sparkSession
    known = vocabulary.for_tasks()
    columns = [name for name, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    row = F.xxhash64(*columns)
    drawn = docs.select(F.col(text).alias("text"), row.alias("row"), F.pmod(row, F.lit(_DRAWS)).alias("draw"))
    shards = max(1, round(share * vocabulary.counts.sum() / _SHARD_WORDS))
    shard = F.pmod(F.xxhash64("row", F.lit("shard")), F.lit(shards)).alias("shard")
    flat = _flat(start(vocabulary))
    for i in range(rounds):
        chosen = drawn.filter(_in_round(F.col("draw"), i, share)).select("text", "row", shard)
        sent = spark.sparkContext.broadcast(flat)  # some 800 KB whatever the corpus

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Each text as the ids of its words as contexts, which tell the words' own ids as well."""
            for batch in batches:
                for part in batches_of(batch):
                    hashes, owner = word_hashes([t or "" for t in part.column("text").to_pylist()])
                    near = context_ids(known.lookup(hashes), hashes).astype("<u2")
                    bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                    held = pa.array([near[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("row"), held], ["shard", "row", "near"])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for number, rows in _runs(batches):
                net = _unflat(sent.value)
                words = train(net, _steps(rows, number, step))
                if words:
                    weighted = _flat(net).astype(np.float64) * words
                    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([words]), pa.array([weighted.tobytes()])], ["salt", "words", "sums"])

        schema = "salt bigint, words bigint, sums binary"
        order = ("shard", "row", "near")
        texts = chosen.mapInArrow(read, "shard bigint, row bigint, near binary").repartition(min(shards, _MOST_TASKS), "shard").sortWithinPartitions(*order)
        sums, left = texts.mapInArrow(run, schema), shards
        while True:
            sums = sums.withColumn("salt", F.floor(F.col("salt") / _FAN_IN).cast("long")).groupBy("salt").applyInArrow(_added, schema)
            left = -(-left // _FAN_IN)
            if left == 1:
                break
        all_of = sums.collect()
        sent.destroy()
        if not all_of:
            break
        flat = (np.frombuffer(all_of[0]["sums"]) / all_of[0]["words"]).astype(np.float32)
    return _unflat(flat)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Rows of sorted batches, shard by shard. Each shard's rows must be used up before the next."""
    rows = ((s, near) for batch in batches for s, near in zip(batch.column("shard").to_pylist(), batch.column("near").to_pylist(), strict=True))
    return ((number, (near for _, near in group)) for number, group in itertools.groupby(rows, key=lambda r: r[0]))


def _steps(rows: Iterator[bytes], number: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words and contexts in steps, mixed among the texts that follow each other."""
    held: list[np.ndarray] = []
    mixed = words = 0

    def mix_held() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        near = np.concatenate(held)
        around = contexts(near, np.repeat(np.arange(len(held)), [len(h) for h in held]))
        ids = np.where(near > PAD, UNKNOWN, near).astype(np.int64)
        order = np.random.default_rng([number, mixed]).permutation(len(ids))
        for at in range(0, len(ids), step):
            use = order[at : at + step]
            yield ids[use], np.take(around, use, axis=0)

    for near in rows:
        held.append(np.frombuffer(near, "<u2"))
        words += len(held[-1])
        if words >= _MIXED:
            yield from mix_held()
            held, words, mixed = [], 0, mixed + 1
    if held:
        yield from mix_held()


def _added(table: pa.Table) -> pa.Table:
    """The sums of some shards, added in a fixed order."""
    rows = sorted(zip(table.column("words").to_pylist(), table.column("sums").to_pylist(), strict=True))
    total = np.zeros(len(rows[0][1]) // 8)
    for _, sums in rows:
        total += np.frombuffer(sums)
    return pa.table({"salt": [table.column("salt")[0].as_py()], "words": [sum(n for n, _ in rows)], "sums": [total.tobytes()]})


def score(docs: DataFrame, vocabulary: Vocabulary, net: dict[str, np.ndarray], text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_words, log_likelihood (sum over all words) and perplexity for every row.

    An unknown word has its probability as such times its own share of all unknown words of the corpus: by the counts that
    every task has, or else by a join with the table of words; one that the corpus does not have counts as seen once. A
    text without words, empty or null, has likelihood 0 and a null perplexity.
    """
    known, unknown = vocabulary.for_tasks(), max(1.0, float(vocabulary.counts[UNKNOWN]))
    sent = docs.sparkSession.sparkContext.broadcast((_flat(net), vocabulary.common or (np.empty(0, np.uint64), np.empty(0, np.int64))))

    @F.arrow_udf("struct<n_words: bigint, logs: double, rare: array<bigint>>")
    def scores(texts: pa.Array) -> pa.Array:
        flat, (common, seen) = sent.value
        own, frequent, shares = _unflat(flat), SortedHashes(common), np.log(np.append(seen, 1) / unknown)
        n, sums, rare, sizes = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
        for part in batches_of(pa.RecordBatch.from_arrays([texts], ["text"])):
            hashes, owner = word_hashes([t or "" for t in part.column("text").to_pylist()])
            ids = known.lookup(hashes)
            logs = log_probabilities(own, ids, contexts(context_ids(ids, hashes), owner))
            others = np.flatnonzero(ids == UNKNOWN)
            at, found = frequent.find(hashes[others])
            logs[others[found]] += shares[at[found]]
            n.append(np.bincount(owner, minlength=part.num_rows))
            sums.append(np.bincount(owner, logs, minlength=part.num_rows))
            rare.append(hashes[others[~found]].view(np.int64))
            sizes.append(np.bincount(owner[others[~found]], minlength=part.num_rows))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32)), pa.array(np.concatenate(rare)))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(n)), pa.array(np.concatenate(sums)), lists], ["n_words", "logs", "rare"])

    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(k) for c, k in zip(keep, names, strict=True)), scores(F.col(text)).alias("_s"))
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("_row"), *names, "_s.*"), "scores")
    # Frequent words are not here, so no key of the join is hot.
    rare = rows.select("_row", F.explode("rare").alias("word")).join(vocabulary.words, "word", "left")
    shares = rare.groupBy("_row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)) / unknown)).alias("shares"))
    out = rows.drop("rare").join(shares, "_row", "left").select(
        *(F.col(k).alias(c) for c, k in zip(keep, names, strict=True)),
        "n_words",
        (F.col("logs") + F.coalesce("shares", F.lit(0.0))).alias("log_likelihood"),
    )
    return out.withColumn("perplexity", F.exp(-F.col("log_likelihood") / F.nullif(F.col("n_words"), F.lit(0))))

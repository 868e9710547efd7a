"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Token counts are summed into cells of source, language and topic. Raking scales them in turn until each of the three
marginals has its target shares; documents are then drawn with their cell's calibrated probability.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.session import materialise

OTHER = "other"
TOPICS = ("lists", "symbols", "capitals", "numbers", "prose")


@dataclass(frozen=True)
class Targets:
    """Wanted shares of tokens.

    ``languages`` and ``topics`` map names to shares; names not listed share what ``other`` is given, or what is left.
    Sources get their observed share of tokens to the power ``source_power`` (1: as observed, 0: all alike), so there
    may be any number of them.
    """

    languages: Mapping[str, float] = field(default_factory=lambda: {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1})
    topics: Mapping[str, float] = field(default_factory=lambda: {"prose": 0.9, "lists": 0.03, "symbols": 0.02, "capitals": 0.02, "numbers": 0.03})
    source_power: float = 0.5
    #: Expected tokens kept, as a share of all.
    keep: float = 0.6
    rounds: int = 20


def topic_of(text: str) -> Column:
    """The form of a text, from shares of its characters: lists, symbols, capitals, numbers or prose."""
    words = F.greatest(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1))
    return (
        F.when(F.regexp_count(text, F.lit(r" \| ")) / words > 0.2, "lists")
        .when(F.regexp_count(text, F.lit(r"[#*$%&<>]+")) / words > 0.2, "symbols")
        .when(F.regexp_count(text, F.lit(r"\p{Lu}{2,}")) / words > 0.3, "capitals")
        .when(F.regexp_count(text, F.lit(r"\d+")) / words > 0.2, "numbers")
        .otherwise("prose")
    )


def token_count(text: str) -> Column:
    """Whitespace-separated words."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _index(column: Column, names: list[str]) -> Column:
    """Position in ``names``; the last stands for all others."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, names[:-1])), column), F.lit(0)), F.lit(len(names))) - 1


def _shares(wanted: Mapping[str, float]) -> tuple[list[str], list[float]]:
    named = {k: v for k, v in wanted.items() if k != OTHER}
    rest = wanted.get(OTHER, max(0.0, 1 - sum(named.values())))
    values = [*named.values(), rest]
    return [*named, OTHER], [v / sum(values) for v in values]


def _fit(margin: list[float], now: list[float]) -> list[float]:
    """Factors that bring ``now`` to the shares of ``margin``; cells without tokens keep 1 and leave their share to others."""
    there = sum(m for m, n in zip(margin, now, strict=True) if n > 0)
    total = sum(now)
    return [m / there * total / n if n > 0 and there > 0 else 1.0 for m, n in zip(margin, now, strict=True)]


def mix_sources(
    docs: DataFrame,
    targets: Targets = Targets(),
    text: str = "text",
    key: str = "doc_id",
    seed: str = "mix",
    into: str = "mix",
) -> DataFrame:
    """``docs`` with a struct ``into``: topic, n_tokens, factor (raked weight of the cell), probability and sampled.

    The draw compares the MD5 of seed and key with the probability, so it is the same on every run; rows with equal
    keys share a draw. Null texts have no tokens and are prose. A null source is a source of its own; null languages
    count as ``other``. A margin whose target is missing from the table leaves its share to the others. Probabilities
    stop at 1: what such cells cannot give is made up by the rest. Other columns pass through; one named ``into`` is
    replaced.

    Sources are rows of a table; languages and topics, whose names are parameters, are positions in arrays. So only one
    number for each language and topic comes to the driver in each round, however many sources there are.
    """
    langs, lang_share = _shares(targets.languages)
    topics, topic_share = _shares(targets.topics)
    n_l, n_t = len(langs), len(topics)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({"_source": F.col("source"), "_topic": topic_of(body), "_tokens": token_count(body)})
    rows = rows.withColumn("_cell", (_index(F.col("lang"), langs) * n_t + _index(F.col("_topic"), topics)).cast("int"))

    cells = [f"c{i}" for i in range(n_l * n_t)]
    table = rows.groupBy(F.col("_source").alias("source")).agg(
        *(F.sum(F.when(F.col("_cell") == i, F.col("_tokens")).otherwise(0)).cast("double").alias(c) for i, c in enumerate(cells))
    )
    table = materialise(table.withColumn("total", sum((F.col(c) for c in cells), F.lit(0.0))), "sources")
    # Powers of the sources' tokens; their sum and the tokens in all scale the first margin.
    spread = table.agg(F.sum("total").alias("tokens"), F.sum(F.pow("total", F.lit(targets.source_power))).alias("powers")).first()
    tokens, powers = spread["tokens"] or 0.0, spread["powers"] or 0.0
    plain = [c for c in docs.columns if c != into]

    def result(factor: Column, probability: Column, sampled: Column) -> list[Column]:
        parts = {"topic": F.col("_topic"), "n_tokens": F.col("_tokens"), "factor": factor, "probability": probability, "sampled": sampled}
        return [*(F.col(c) for c in plain), F.struct(*(c.alias(n) for n, c in parts.items())).alias(into)]

    if not tokens:
        return rows.select(*result(F.lit(0.0), F.lit(0.0), F.lit(False)))
    lang_of = [i // n_t for i in range(n_l * n_t)]
    topic_at = [i % n_t for i in range(n_l * n_t)]
    by_lang, by_topic = [1.0] * n_l, [1.0] * n_t

    def source_factor() -> Column:
        held = sum((F.col(c) * (by_lang[lang_of[i]] * by_topic[topic_at[i]]) for i, c in enumerate(cells)), F.lit(0.0))
        wanted = F.pow("total", F.lit(targets.source_power)) * (tokens / powers)
        return F.when(held > 0, wanted / held).otherwise(0.0)

    def raked() -> list[float]:
        """Tokens in each cell of language and topic, with the sources at their targets."""
        factor = table.withColumn("_f", source_factor())
        got = factor.agg(*(F.sum(F.col(c) * F.col("_f")).alias(c) for c in cells)).first()
        return [(got[c] or 0.0) * by_lang[lang_of[i]] * by_topic[topic_at[i]] for i, c in enumerate(cells)]

    for _ in range(targets.rounds):
        now = raked()
        fix = _fit(lang_share, [sum(v for i, v in enumerate(now) if lang_of[i] == k) for k in range(n_l)])
        now = [v * fix[lang_of[i]] for i, v in enumerate(now)]
        by_lang = [v * f for v, f in zip(by_lang, fix, strict=True)]
        more = _fit(topic_share, [sum(v for i, v in enumerate(now) if topic_at[i] == k) for k in range(n_t)])
        by_topic = [v * f for v, f in zip(by_topic, more, strict=True)]
        if max(abs(f - 1) for f in [*fix, *more]) < 1e-9:
            break
    pair = F.array(*(F.lit(by_lang[lang_of[i]] * by_topic[topic_at[i]]) for i in range(n_l * n_t)))
    factors = materialise(table.select("source", source_factor().alias("_by_source"), *cells), "factors")

    def kept_at(scale: float) -> float:
        part = (F.col(c) * F.least(F.lit(1.0), F.col("_by_source") * (by_lang[lang_of[i]] * by_topic[topic_at[i]] * scale)) for i, c in enumerate(cells))
        return factors.agg(F.sum(sum(part, F.lit(0.0)))).first()[0] or 0.0

    scale = _solve(kept_at, targets.keep * tokens, targets.keep)
    factors = factors.select(F.col("source").alias("_of"), "_by_source")
    joined = rows.join(factors, F.col("_source").eqNullSafe(F.col("_of")))
    factor = F.col("_by_source") * pair[F.col("_cell")]
    probability = F.least(F.lit(1.0), factor * scale)
    digits = F.substring(F.md5(F.concat_ws("-", F.lit(seed), F.col(key).cast("string"))), 1, 13)
    draw = F.conv(digits, 16, 10).cast("double") / float(16**13)
    return joined.select(*result(factor, probability, draw < probability))


def _solve(kept_at, wanted: float, start: float, rounds: int = 12) -> float:
    """The scale at which the expected tokens reach ``wanted``, or the largest tried where too few cells have weight."""
    scale = start
    for _ in range(rounds):
        got = kept_at(scale)
        if got <= 0 or abs(got / wanted - 1) < 1e-4:
            break
        scale *= wanted / got
    return scale

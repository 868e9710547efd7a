"""Quality rules by weak supervision, with DataFrame functions only.

Rules look at counts of a text and vote good, bad or abstain. Expectation-maximisation over the counts of vote
patterns estimates how each rule votes on good and on bad texts; the posterior decides instead of "all must pass".
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilnwork.session import materialise

#: What separates words, and the characters counted as symbols.
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in a is that for it with as was on be by this are from at or an not have "
    "le la les de des et un une du que qui dans pour par sur est avec au en pas "
    "der die das und ein zu von mit sich ist nicht den im auf es eine dem "
    "el los las y por con no para del se lo su al como"
).split()
GOOD, BAD, ABSTAIN = 1, -1, 0


@dataclass(frozen=True)
class Rule:
    """Votes bad at or above ``bad``, good at or below ``good``, else abstains (``flip``: the other way round)."""

    name: str
    value: str
    good: float
    bad: float
    flip: bool = False

    def vote(self) -> Column:
        value = F.expr(self.value)
        is_bad, is_good = (value <= self.bad, value >= self.good) if self.flip else (value >= self.bad, value <= self.good)
        return F.when(is_bad, BAD).when(is_good, GOOD).otherwise(ABSTAIN).cast("int")


RULES = (
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.02, 0.10),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", 0.10, 0.30),
    Rule("lines", "try_divide(n_dup_lines, n_lines)", 0.10, 0.30),
    Rule("long_words", "try_divide(word_chars, n_words)", 9.0, 12.0),
    Rule("short_words", "try_divide(word_chars, n_words)", 3.0, 2.0, flip=True),
    Rule("function_words", "try_divide(n_function_words, n_words)", 0.10, 0.03, flip=True),
    Rule("capitals", "try_divide(n_capital_runs, n_words)", 0.10, 0.30),
)


def text_counts(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the counts of each whole text; a null text has no words.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word), n_dup_lines (those equal to an
    earlier one), n_repeat_words (words in 3-word windows that occur twice or more), n_function_words and
    n_capital_runs (runs of two or more capitals).
    """
    # inline() keeps each array as a value: as a plain projection it would be evaluated anew for every element below.
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    split = base.selectExpr(
        *keep,
        f"length(regexp_replace(_text, '[^{SYMBOLS}]+', '')) as n_symbols",
        r"length(regexp_replace(_text, '[\\x20\\x09-\\x0D]+', '')) as word_chars",
        r"regexp_count(_text, '\\p{Lu}{2,}') as n_capital_runs",
        "inline(array(named_struct("
        r"'_words', array_remove(split(_text, '[\\x20\\x09-\\x0D]+'), ''), "
        r"'_lines', filter(split(_text, '\\n'), x -> x rlike '[^\\x20\\x09-\\x0D]'))))",
    )
    listed = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)
    windows = split.selectExpr(
        *keep,
        "n_symbols",
        "word_chars",
        "n_capital_runs",
        "size(_words) as n_words",
        "size(_lines) as n_lines",
        "size(_lines) - size(array_distinct(_lines)) as n_dup_lines",
        f"size(filter(_words, x -> lower(x) in ({listed}))) as n_function_words",
        "inline(array(named_struct('_windows', if(size(_words) < 3, array(), sort_array(transform("
        "sequence(0, size(_words) - 3), "
        "i -> named_struct('h', xxhash64(_words[i], _words[i + 1], _words[i + 2]), 'i', i)))))))",
    )
    again = (
        "filter(_windows, (x, k) -> (k > 0 and get(_windows, k - 1).h = x.h) or "
        "(k < size(_windows) - 1 and get(_windows, k + 1).h = x.h))"
    )
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_function_words", "n_capital_runs")
    return windows.selectExpr(
        *keep,
        *(f"cast({n} as bigint) as {n}" for n in names),
        f"cast(size(array_distinct(flatten(transform({again}, x -> array(x.i, x.i + 1, x.i + 2))))) as bigint) "
        "as n_repeat_words",
    )


Votes = tuple[int, ...]


@dataclass(frozen=True)
class VoteModel:
    """``prior``: share of good texts. ``tables[j][v]``: log P(vote v of rule j | good) - log P(... | bad)."""

    prior: float
    tables: tuple[Mapping[int, float], ...]

    def log_odds(self, votes: Sequence[Column]) -> Column:
        total: Column = F.lit(math.log(self.prior) - math.log1p(-self.prior))
        for vote, table in zip(votes, self.tables, strict=True):
            total = total + F.when(vote == GOOD, table[GOOD]).when(vote == BAD, table[BAD]).otherwise(table[ABSTAIN])
        return total


def fit_votes(patterns: Mapping[Votes, int], rounds: int = 50, smooth: float = 1.0) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts, of which there are at most 3^rules.

    Starts from "bad if any rule says bad", which also settles which class is which. No patterns: every vote counts
    for nothing and the prior is a half.
    """
    values = (GOOD, BAD, ABSTAIN)
    n_rules = len(next(iter(patterns), ()))
    good = {p: 0.05 if BAD in p else 0.95 for p in patterns}
    prior, tables = 0.5, tuple({v: 0.0 for v in values} for _ in range(n_rules))
    for _ in range(rounds):
        weight = {True: smooth, False: smooth}
        seen = {True: [dict.fromkeys(values, smooth) for _ in range(n_rules)], False: [dict.fromkeys(values, smooth) for _ in range(n_rules)]}
        for p, n in patterns.items():
            for side, share in ((True, good[p] * n), (False, (1 - good[p]) * n)):
                weight[side] += share
                for j, v in enumerate(p):
                    seen[side][j][v] += share
        prior = weight[True] / (weight[True] + weight[False])
        norm = {side: [sum(t.values()) for t in seen[side]] for side in (True, False)}
        tables = tuple(
            {
                v: math.log(seen[True][j][v] / norm[True][j]) - math.log(seen[False][j][v] / norm[False][j])
                for v in values
            }
            for j in range(n_rules)
        )
        base = math.log(prior) - math.log1p(-prior)
        for p in patterns:
            odds = base + sum(tables[j][v] for j, v in enumerate(p))
            good[p] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
    return VoteModel(prior, tables)


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: Sequence[Rule] = RULES,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    threshold: float = 0.5,
) -> DataFrame:
    """Counts, votes, ``quality`` (posterior of good) and ``kept`` for every row.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` % of them in repeated windows.
    Such rows are not kept and take no part in the fit. Null and empty texts have no words, so they fail. Rows with
    equal or null keys are judged each by themselves. Other columns of ``docs`` are ignored.
    """
    counts = text_counts(docs, text, [key])
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    names = [f"vote_{r.name}" for r in rules]
    voted = counts.withColumn("base_failed", failed).withColumns(
        {n: F.coalesce(r.vote(), F.lit(ABSTAIN)) for n, r in zip(names, rules, strict=True)}
    )
    voted = materialise(voted, "votes")
    # At most 3^rules rows reach the driver.
    patterns = {
        tuple(row[n] for n in names): row["count"]
        for row in voted.filter("not base_failed").groupBy(*names).count().collect()
    }
    odds = fit_votes(patterns).log_odds([F.col(n) for n in names]) if patterns else F.lit(0.0)
    quality = 1 / (1 + F.exp(-odds))
    return voted.withColumn("quality", quality).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )

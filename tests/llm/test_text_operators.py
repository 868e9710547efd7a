"""Quality rules, fingerprints, mixing and language: counts against plain Python, and odd rows."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kilnwork.llm import fingerprints, language, mixing, quality_model, rules

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality string"
ODD = [
    None, "", "   \n\t ", "one", "a b c d", "a b c a b c a b c", "é ü ß", "x " * 3000, "line\nline\n\nline\n",
    "#*$ %&| <>", "THE END OF ALL", "z" * 100_000, "one", "日本 語 の 文 章", "a\r\nb\x0bc\x0cd", "\x00 nul \x1f x",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ["en", None, "xx"][i % 3], ["s", None][i % 2], 0, "q") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, (None, "no id", "en", "s", 0, "q"), rows[3], rows[3]], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def counts_of(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = collections.Counter(grams)
    again = {j for i, g in enumerate(grams) if seen[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_rule_counts(spark, docs, odd):
    for df in (docs, odd):
        texts = {(r["doc_id"], r["text"]): counts_of(r["text"]) for r in df.collect()}
        got = rules.text_counts(df, keep=["doc_id", "text"]).collect()
        assert len(got) == df.count()
        for r in got:
            assert tuple(r[n] for n in NAMES) == texts[r["doc_id"], r["text"]], r["doc_id"]


def test_quality_rules_verdicts(spark, docs, sf_dir, odd):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = rules.quality_rules(docs).collect()
    failed = {r["doc_id"]: r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"] for r in got}
    assert all(r["base_failed"] == failed[r["doc_id"]] and not (r["kept"] and r["base_failed"]) for r in got)
    judged = [(r["kept"], labels[r["doc_id"]]) for r in got if r["doc_id"] in labels and not r["base_failed"]]
    assert np.mean([k == bool(q) for k, q in judged]) > 0.95
    assert not any(r["kept"] for r in rules.quality_rules(odd).collect())
    assert rules.quality_rules(odd.limit(0)).count() == 0


def test_votes_recover_accuracies():
    random = np.random.default_rng(3)
    good = random.random(20_000) < 0.8
    patterns = collections.Counter()
    for g in good:
        vote = lambda right, silent: 0 if random.random() < silent else (1 if (random.random() < right) == g else -1)  # noqa: B023, E731
        patterns[vote(0.95, 0.2), vote(0.9, 0.4), vote(0.85, 0.0)] += 1
    model = rules.fit_votes(patterns)
    assert abs(model.prior - 0.8) < 0.05
    assert model.tables[0][1] > 0 > model.tables[0][-1]
    assert rules.fit_votes({}).prior == 0.5


def test_fingerprints(spark, docs, odd):
    for df in (docs, odd.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = sorted((r["doc_id"], r["text"] or "") for r in df.collect())
        got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
        assert len(got) == len(rows)
        by_text = {}
        for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
            n = len(text) // 4
            edited = text[: len(text) - n] + following[:n]
            assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert got[i]["n_chars"] == len(text) and 0 <= got[i]["near_edited"] <= 1
            assert by_text.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
            if edited == text:
                assert got[i]["near_edited"] == 1
    assert fingerprints.edited_fingerprints(docs.limit(0)).count() == 0
    assert fingerprints.edited_fingerprints(odd).count() == odd.count()


def test_sketches_estimate_and_merge(spark):
    words = [f"w{i}" for i in range(6000)]
    texts = {"a": words[:4000], "b": words[1000:6000], "small": words[100:400]}
    df = spark.createDataFrame([(" ".join(t),) for t in texts.values()], "text string").coalesce(1)
    rows = fingerprints.with_sketch(df, "text", "s").collect()
    a, b, small = (r["s"] for r in rows)
    row = spark.createDataFrame([(a, b, small)], "a array<long>, b array<long>, c array<long>")
    got = row.select(
        fingerprints.likeness("a", "b").alias("j"), fingerprints.containment("c", "a").alias("c"), fingerprints.merged("a", "b").alias("m")
    ).first()
    assert abs(got["j"] - 0.5) < 0.06 and got["c"] == 1.0
    assert set(got["m"]) == set(a) | set(b) and abs(len(a) / 4000 - 0.25) < 0.03


def test_short_texts_keep_all_their_shingles(spark):
    texts = [f"short text {i}" for i in range(40)] + [" ".join(f"w{i}-{k}" for k in range(12)) for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(fingerprints.edited_fingerprints(df).collect(), key=lambda r: r["doc_id"])
    assert len({r["fingerprint"] for r in got}) == len(texts) and "" not in {r["fingerprint"] for r in got}
    assert all(r["near_next"] == 0 for r in got)

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    for r, text, following in zip(got, texts, texts[1:] + texts[:1]):
        n = len(text) // 4
        a, b = shingles(text), shingles(text[: len(text) - n] + following[:n])
        assert r["n_shingles"] == len(a) and r["edited_n_shingles"] == len(b)
        assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 1e-9
    # A short text and a long one that holds it; two short ones that merge to one still whole.
    pair = fingerprints.with_sketch(spark.createDataFrame([("a b c d e f", "g h")], "x string, y string"), "x", "s")
    pair = fingerprints.with_sketch(pair, "y", "t").withColumn("m", fingerprints.merged("s", "t", "s_n", "t_n"))
    row = pair.first()
    assert set(row["m"]) == set(row["s"]) | set(row["t"]) and len(row["m"]) == 3


def test_mixing_reaches_its_margins(spark, docs, odd):
    rows = mixing.mix_sources(docs).select("doc_id", "source", "lang", "mix.*").collect()
    total = sum(r["n_tokens"] * r["factor"] for r in rows)
    for column, wanted in (("lang", mixing.Targets().languages), ("topic", mixing.Targets().topics)):
        share = collections.Counter()
        for r in rows:
            share[r[column]] += r["n_tokens"] * r["factor"] / total
        there = sum(wanted[k] for k in share)
        assert all(abs(share[k] - wanted[k] / there) < 0.01 for k in share), (column, share)
    tokens = sum(r["n_tokens"] for r in rows)
    assert abs(sum(r["n_tokens"] * r["probability"] for r in rows) / tokens - 0.6) < 0.01
    again = {r["doc_id"]: r["mix"]["sampled"] for r in mixing.mix_sources(docs.repartition(5)).collect()}
    assert all(again[r["doc_id"]] == r["sampled"] for r in rows)
    out = mixing.mix_sources(odd.withColumn("mix", F.lit(1)))
    assert out.count() == odd.count() and out.columns == [*odd.columns, "mix"]
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    assert mixing.mix_sources(odd.filter("text is null or text = ''")).count() > 0


def test_language(spark, docs, odd, sf_dir):
    model = language.fit_text_model(docs)
    rows = language.identify(docs, model).select("doc_id", "lang", "lid.*").collect()
    assert np.mean([r["lang"] == r["language"] for r in rows]) > 0.98
    blind = language.identify(docs, model, declared=None, host=None).select("lang", "lid.*").collect()
    assert np.mean([r["lang"] == r["text_language"] for r in blind]) > 0.95
    got = language.identify(odd.withColumn("lid", F.lit(0)), model)
    assert got.count() == odd.count() and got.columns == [*odd.columns, "lid"]
    by_text = {r["text"]: r["lid"] for r in got.collect()}
    for text in (None, "", "   \n\t ", "#*$ %&| <>"):
        assert by_text[text]["language"] == "und" and not by_text[text]["kept"]
    assert language.identify(docs.limit(0), model).count() == 0
    assert language.fit_text_model(docs.limit(0)).logp.shape[0] == 5


def test_language_model_counts_every_labelled_row(spark):
    word = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    lang = F.when(F.col("id") % 500 == 1, "de").when(F.col("id") % 2 == 1, "en").when(F.col("id") % 4 == 0, "xx")
    docs = spark.range(50_000).select(F.when(F.col("id") % 100 != 3, F.concat_ws(" ", lang, word)).alias("text"), lang.alias("lang"))
    texts = {name: [r["text"] or "" for r in docs.filter(F.col("lang") == name).collect()] for name in ("en", "de")}
    assert len(texts["en"]) > 20_000  # by sample: some 20,000 of them
    for rows in (docs, docs.repartition(3)):
        model = language.fit_text_model(rows)
        for name in model.languages:
            counts = np.bincount(language.trigrams(texts.get(name, []))[0], minlength=language.BUCKETS) + 0.5
            assert np.allclose(model.logp[model.languages.index(name)], np.log(counts / counts.sum()), rtol=0, atol=1e-5), name


def test_host_prior_decides_where_the_text_does_not(spark):
    rows = [(i, "the of and", "en", "a.example.org") for i in range(40)] + [(100 + i, "der die und", "de", "b.example.de") for i in range(40)]
    rows += [(500, "xyz", None, "b.example.de"), (501, "xyz", None, "a.example.org")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    model = language.fit_text_model(df)
    got = language.identify(df, model, host="host", suffix=language.address_suffix(F.col("host")))
    found = {r["doc_id"]: r["lid"]["language"] for r in got.filter("doc_id >= 500").collect()}
    assert found[500] in ("de", "und") and found[501] in ("en", "und")


def test_quality_classifier(spark, docs, odd, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    votes, scorer = quality_model.fit(docs)
    got = {r["doc_id"]: r["kept"] for r in quality_model.score(docs, scorer).collect()}
    # The labels were never seen by the fit.
    assert np.mean([got[i] == bool(q) for i, q in labels.items()]) > 0.9
    rows = quality_model.score(odd, scorer, keep=["doc_id", "text"]).collect()
    assert len(rows) == odd.count()
    assert all(not r["kept"] and r["quality"] == 0 for r in rows if not (r["text"] or "").strip())
    empty = quality_model.fit(docs.limit(0))[1]
    assert quality_model.score(docs.limit(0), empty).count() == 0


def test_sample_of_the_quality_classifier_is_bounded_with_copies(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(quality_model, "fit_scorer", lambda rows: sizes.append(len(rows)))
    for text in ("one text of all rows", "another text of all rows", "a third text of all rows"):
        docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
        quality_model.fit(docs, sample_rows=200)
    assert all(120 < n < 280 for n in sizes)  # drawn by text: all 2,000 or none


def test_languages_are_scored_once_and_long_texts_in_parts(spark, sf_dir, monkeypatch):
    plans = []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, name)

    materialise = language.materialise
    monkeypatch.setattr(language, "materialise", seen)
    rows = spark.createDataFrame([(1, "the cat and the dog", "en", "a"), (2, "123", "en", "a"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["lid"] for r in language.identify(rows, language.fit_text_model(rows)).collect()}
    assert sum(plan.count("ArrowEvalPython") for plan in plans) == 1
    assert [got[i]["language"] for i in (1, 2, 3)] == ["en", "und", "und"] and got[2]["probability"] == 1

    texts = ["é!", "Der Öl ist schön 漢字. " * 20_000, None, "end"]
    whole, bounds = language.trigrams([t or "" for t in texts])
    parts = [bytearray() for _ in texts]
    for first, buckets, at in language.trigram_runs(pa.array(texts), 1 << 12):
        assert len(buckets) <= 1 << 12
        for i in range(len(at) - 1):
            parts[first + i] += buckets[at[i] : at[i + 1]].astype("u2").tobytes()
    for i, part in enumerate(parts):
        assert bytes(part) == whole[bounds[i] : bounds[i + 1]].astype("u2").tobytes()

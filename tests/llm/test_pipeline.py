"""The stages of the corpus pipeline, each on what the one before kept."""

import pytest

import corpus_pipeline
from kilnwork.llm import language, mixing, near_dedup, suffix_dedup
from kilnwork.session import materialise


def test_stages_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert len(rows) == docs.count()
        ids = {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "language_id":
            found = language.identify(before, language.fit_text_model(before)).select("doc_id", "lid.kept").collect()
            assert set(rows) == {r["doc_id"] for r in found if r["kept"]}
        elif name == "near_duplicates":
            found = near_dedup.near_duplicates(before).collect()
            assert set(rows) == {r["doc_id"] for r in found if r["kept"]} and len({r["class_id"] for r in found}) == len(rows)
        elif name == "repeated_passages":
            found = {r["doc_id"]: r["kept_text"] for r in suffix_dedup.remove_repeats(before).collect()}
            assert set(rows) == ids and all(r["text"] == found[i] and r["n_chars"] == len(r["text"]) for i, r in rows.items())
        elif name == "source_mix":
            found = mixing.mix_sources(before).select("doc_id", "mix.sampled").collect()
            assert set(rows) == {r["doc_id"] for r in found if r["sampled"]}
        else:
            assert set(rows) == ids and all(r["round_trip"] for r in rows.values())
        if name != "token_ids":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = set(rows)
    last = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert last == kept["token_ids"] and last


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_pass_every_stage(spark, sf_dir, empty):
    rows = [
        (1, None, "en", "s", 0, 1), (2, "", None, None, 0, 1), (None, "the and of with this", "en", "s", 9, 1), (None, None, None, None, None, None),
        (3, "the and of with this", "en", "s", 9, 1), (3, "the and of with this", "en", "s", 9, 1), (4, "the of and to in is that " * 3000, "en", "t", 0, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, class_id int")
    docs = docs.limit(0) if empty else docs
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = materialise(stage(spark, docs, sf_dir), name)
        if name != "token_ids":
            assert docs.columns == columns
        if name == "near_duplicates":
            assert docs.filter("doc_id = 3").count() == (0 if empty else 1)
    assert empty == (docs.count() == 0) or docs.count() <= 2

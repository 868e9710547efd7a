"""A corpus pipeline: from raw documents to token ids, in stages that each write their documents for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwork.llm import language, mixing, near_dedup, pieces, suffix_dedup
from kilnwork.session import materialise, ship_package

#: A public vocabulary; any SentencePiece model will do.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the known languages."""
    ship_package(spark)
    found = language.identify(docs, language.fit_text_model(docs), into="_lid")
    return found.filter("_lid.kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each near-duplicate class; repeated rows count once."""
    ship_package(spark)

    def row(key, digest):
        return F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("none")), digest))

    decided = near_dedup.near_duplicates(docs).filter("kept")
    kept = decided.select(row(F.col("doc_id"), F.col("text_md5")).alias("_row")).distinct()
    marked = docs.withColumn("_row", row(F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))))
    return marked.join(kept, "_row", "left_semi").dropDuplicates(["_row"]).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages out of each document that a document with a smaller id has too; no document goes."""
    ship_package(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    left = suffix_dedup.remove_repeats(docs, keep=others)
    left = left.select(*others, F.col("kept_text").alias("text"), F.length("kept_text").cast("long").alias("n_chars"))
    return left.select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics have their target weights."""
    return mixing.mix_sources(docs, into="_mix").filter("_mix.sampled").select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    ship_package(spark)
    return pieces.encode(docs, pieces.read_model(MODEL_PATH), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: None: signatures, suffix order and token ids have no counterpart in SQL. The tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

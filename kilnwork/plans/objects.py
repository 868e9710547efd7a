"""File trees, object listings, suffix tests and previews."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.functions import text
from kilnwork.operators import models, rollups, scoring
from kilnwork.plans.inputs import OBJECTS_SQL, objects, table
from kilnwork.session import materialise, scratch_path
from kilnwork.sources import files, trees

_ROWS_PER_FILE = 1000  # keeps each file of the tree far below the 2 GB a binary value can hold


def _written_tree(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a tree of text files."""
    root = scratch_path(spark, "tree")
    docs = table(spark, sf_dir, "documents").select("lang", "source", F.col("text").alias("value"))
    # Rebalanced by folder: otherwise every task leaves a small file in every folder. Spark splits
    # a folder that is much larger than the others over several tasks.
    docs = docs.hint("rebalance", "lang", "source")
    docs.write.option("maxRecordsPerFile", _ROWS_PER_FILE).partitionBy("lang", "source").text(root)
    return root


def inventory_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree listed by tasks, packed into splits of 64 KB, and read split by split."""
    root = _written_tree(spark, sf_dir)
    listed = materialise(trees.packed(trees.list_tree(spark, root), 64 << 10), "packed")
    read = trees.read_packed(listed, root).select("key", F.octet_length("bytes").cast("long").alias("read"))
    return (
        listed.join(read, "key", "left")
        .groupBy(F.regexp_extract("key", "/lang=([^/]*)/", 1).alias("lang"), F.regexp_extract("key", "/source=([^/]*)/", 1).alias("source"))
        .agg(F.sum("size").alias("total_bytes"), F.sum("read").alias("read_bytes"), F.count("error").alias("errors"))
    )


def scan_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as a tree of text files, then scanned as bytes.

    Where file boundaries fall is up to the writer, so the bytes are summed by folder.
    """
    root = _written_tree(spark, sf_dir)
    found = files.scan_binary(spark, root, glob="*.txt")
    return (
        found.select(
            F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang"),
            F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source"),
            F.octet_length("bytes").cast("long").alias("size"),
        )
        .groupBy("lang", "source")
        .agg(F.sum("size").alias("total_bytes"))
    )


def filter_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = objects(spark, sf_dir).select("doc_id", "path")
    return rows.filter(text.is_image(F.col("path")))


def filter_ext_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url")
    return rows.filter(text.is_image(F.col("url"), (*text.IMAGE_SUFFIXES, ".html")))


def preview_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("doc_id", "path", text.preview_kind(F.col("path")).alias("preview_kind"))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scorer returns is counted; an image without content gets a prediction too."""
    rows = objects(spark, sf_dir)
    is_image = text.is_image(F.col("path"))
    sizes = rows.filter(is_image).select("path", F.array(F.octet_length("content").cast("double")).alias("size"))
    by_size = models.LinearModel(np.array([[1e-3], [0.0]]), np.zeros(2))
    loader = models.broadcast_loader(spark, by_size)
    scored = scoring.score(sizes, loader, scoring.vector_features("size", 1), batch_size=4096)
    return rollups.stage_counts(rows, is_image, scored.filter("predicted_class is not null"))


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("url").alias("key"), F.octet_length(F.encode("html", "UTF-8")).cast("long").alias("size")
    )
    return files.describe_objects(pages)


def object_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").agg(F.count(F.lit(1)).alias("objects"))


def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("doc_id", text.text_preview(F.col("content")).alias("preview"))


def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = table(spark, sf_dir, "documents")
    return logs.select(F.col("doc_id").alias("job_id"), text.log_tail(F.col("text")).alias("log"))


QUERIES = {
    "scan_binary": scan_binary,
    "inventory_tree": inventory_tree,
    "filter_ext": filter_ext,
    "filter_ext_pages": filter_ext_pages,
    "preview_kind": preview_kind,
    "stage_counts": stage_counts,
    "object_inventory": object_inventory,
    "object_count": object_count,
    "text_preview": text_preview,
    "log_tail": log_tail,
}

_IMAGES = r"'\.(jpg|jpeg|png|bmp|tiff|webp)$'"

ORACLES = {
    "scan_binary": """
        SELECT lang, source, sum(octet_length(encode(text)) + 1)::BIGINT AS total_bytes FROM documents GROUP BY 1, 2
    """,
    "inventory_tree": """
        SELECT lang, source, sum(octet_length(encode(text)) + 1)::BIGINT AS total_bytes,
               sum(octet_length(encode(text)) + 1)::BIGINT AS read_bytes, 0 AS errors FROM documents GROUP BY 1, 2
    """,
    "filter_ext": f"SELECT doc_id, path FROM ({OBJECTS_SQL}) WHERE regexp_matches(lower(path), {_IMAGES})",
    "filter_ext_pages": r"""
        SELECT page_id, url FROM pages WHERE regexp_matches(lower(url), '\.(jpg|jpeg|png|bmp|tiff|webp|html)$')
    """,
    "preview_kind": rf"""
        SELECT doc_id, path,
               CASE WHEN regexp_matches(path, '\.(txt|csv|json)$') THEN 'text'
                    WHEN regexp_matches(path, '\.(png|jpg|jpeg)$') THEN 'image' ELSE 'none' END AS preview_kind
        FROM ({OBJECTS_SQL})
    """,
    "stage_counts": f"""
        SELECT count(*) AS loaded, count(*) FILTER (regexp_matches(lower(path), {_IMAGES})) AS images,
               count(*) FILTER (regexp_matches(lower(path), {_IMAGES})) AS predictions
        FROM ({OBJECTS_SQL})
    """,
    "object_inventory": r"""
        WITH o AS (SELECT url AS key, octet_length(encode(html)) AS size FROM pages)
        SELECT key, size, regexp_extract(key, '[^/]*$') AS name, printf('%.1f', size / 1024) || ' KB' AS size_kb,
               CASE WHEN regexp_matches(key, '\.(txt|csv|json)$') THEN 'text'
                    WHEN regexp_matches(key, '\.(png|jpg|jpeg)$') THEN 'image' ELSE 'none' END AS preview_kind
        FROM o
    """,
    "object_count": "SELECT count(*) AS objects FROM pages",
    "text_preview": "SELECT doc_id, left(text, 500) AS preview FROM documents",
    "log_tail": "SELECT doc_id AS job_id, right(text, 1024) AS log FROM documents",
}

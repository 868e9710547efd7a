"""File trees: raw bytes, decoded images, inventories, store options."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.functions import text


def s3a_options(
    access_key: str | None = None,
    secret_key: str | None = None,
    session_token: str | None = None,
    endpoint: str | None = None,
    anonymous: bool = False,
) -> dict[str, str]:
    """Settings for an S3-compatible store. Without a key, the default credential chain applies.

    Pass them to the scans below, which then apply to that read only, or set them on a session.
    """
    if anonymous and access_key:
        raise ValueError("anonymous access takes no key")
    if bool(access_key) != bool(secret_key):
        raise ValueError("access key and secret key go together")
    if session_token and not access_key:
        raise ValueError("a session token needs an access key")
    provider = "org.apache.hadoop.fs.s3a."
    options: dict[str, str | None] = {
        "access.key": access_key,
        "secret.key": secret_key,
        "session.token": session_token,
        "endpoint": endpoint,
        "path.style.access": "true" if endpoint else None,
    }
    if anonymous:
        options["aws.credentials.provider"] = provider + "AnonymousAWSCredentialsProvider"
    elif session_token:
        options["aws.credentials.provider"] = provider + "TemporaryAWSCredentialsProvider"
    elif access_key:
        options["aws.credentials.provider"] = provider + "SimpleAWSCredentialsProvider"
    return {f"spark.hadoop.fs.s3a.{name}": value for name, value in options.items() if value}


def resolve_uri(uri: str) -> tuple[str, bool]:
    """An ``s3://`` URI as the ``s3a://`` form, and whether it asks for anonymous access."""
    found = re.fullmatch(r"s3a?://(anonymous@)?(.*)", uri, flags=re.DOTALL)
    if not found:
        return uri, False
    return f"s3a://{found.group(2)}", found.group(1) is not None


def scan_files(spark: SparkSession, uri: str, store: dict[str, str] | None = None) -> DataFrame:
    """``path, modificationTime, length, content`` of every file; unused columns are not read."""
    return _tree(spark, "binaryFile", uri, None, store)


def scan_binary(
    spark: SparkSession, uri: str, glob: str | None = None, store: dict[str, str] | None = None
) -> DataFrame:
    """``path, bytes`` of every file below ``uri``; ``glob`` skips files without opening them."""
    return _tree(spark, "binaryFile", uri, glob, store).select("path", F.col("content").alias("bytes"))


def scan_images(spark: SparkSession, uri: str, store: dict[str, str] | None = None) -> DataFrame:
    """Image files below ``uri``, decoded: ``path`` and an ``image`` struct.

    The suffix test runs twice: as a glob, so that other files are not read,
    and on the path. ``height`` is -1 where the bytes could not be decoded.
    """
    decoded = _tree(spark, "image", uri, text.suffix_glob(), store)
    return decoded.select(F.col("image.origin").alias("path"), "image").filter(text.is_image(F.col("path")))


def inventory(spark: SparkSession, uri: str, store: dict[str, str] | None = None) -> DataFrame:
    """``key, size, modified`` of every file; contents are not read."""
    return _tree(spark, "binaryFile", uri, None, store).select(
        F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )


def describe_objects(objects: DataFrame) -> DataFrame:
    """Add the display name, size in KB and kind of preview to ``key, size`` rows."""
    key = F.col("key")
    return objects.withColumns(
        {
            "name": text.basename(key),
            "size_kb": text.size_kb(F.col("size")),
            "preview_kind": text.preview_kind(key),
        }
    )


def preview_texts(spark: SparkSession, uri: str, store: dict[str, str] | None = None) -> DataFrame:
    """``key, preview`` of the text objects below ``uri``; NULL where the bytes are not UTF-8."""
    globs = "*.{" + ",".join(s.lstrip(".") for s in text.PREVIEW_TEXT_SUFFIXES) + "}"
    found = _tree(spark, "binaryFile", uri, globs, store).filter(text.preview_kind(F.col("path")) == "text")
    return found.select(F.col("path").alias("key"), text.text_preview(F.col("content")).alias("preview"))


def _tree(
    spark: SparkSession, source: str, uri: str, glob: str | None, store: dict[str, str] | None
) -> DataFrame:
    reader = spark.read.format(source).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for name, value in (store or {}).items():
        reader = reader.option(name.removeprefix("spark.hadoop."), value)
    return reader.load(uri)

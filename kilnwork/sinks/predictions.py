"""Writing result tables in the format their path asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


_FORMATS = {".csv": "csv", ".json": "json"}
# Spaces, empty strings, NULLs, quotes and line breaks all come back as they were written.
_CSV = {
    "header": "true",
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def output_format(path: str) -> str:
    """``.json`` and ``.csv`` paths name their format, every other path means Parquet."""
    return next((name for suffix, name in _FORMATS.items() if path.endswith(suffix)), "parquet")


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``df``; the result is a folder of part files, also for ``x.json`` and ``x.csv``."""
    fmt = output_format(path)
    if fmt == "csv":
        df = _as_text(df)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    writer.format(fmt).save(path)


def read_predictions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what :func:`write_predictions` wrote."""
    fmt = output_format(path)
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if _nested(f.dataType) else f.dataType) for f in schema]
    )
    rows = spark.read.schema(flat).options(**_CSV).csv(path)
    return rows.select([_restored(f).alias(f.name) for f in schema])


def _restored(field: T.StructField) -> Column:
    if _nested(field.dataType):
        return F.from_json(field.name, field.dataType)
    return _unescaped(F.col(field.name)) if isinstance(field.dataType, T.StringType) else F.col(field.name)


# Every backslash of a written text begins one of these, so they can be undone one after the other.
_EMPTY = "\\e"
_ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def _escaped(text: Column) -> Column:
    """Line breaks as escapes: a row is one line, so that files can be split, and no text looks like NULL."""
    for plain, sign in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(sign))
    return F.when(text == "", _EMPTY).otherwise(text)


def _unescaped(text: Column) -> Column:
    plain_text = text
    for plain, sign in reversed(_ESCAPES):
        plain_text = F.replace(plain_text, F.lit(sign), F.lit(plain))
    return F.when(text == _EMPTY, "").otherwise(plain_text)


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def _as_text(df: DataFrame) -> DataFrame:
    def flat(field: T.StructField) -> Column:
        if _nested(field.dataType):
            return F.to_json(field.name)
        return _escaped(F.col(field.name)) if isinstance(field.dataType, T.StringType) else F.col(field.name)

    return df.select([flat(f).alias(f.name) for f in df.schema])

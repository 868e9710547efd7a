"""The text format in which targets expose metrics, read by column functions.

A line is a sample (name, labels in braces, value, and maybe a time in milliseconds), a comment, or empty. Comments that
begin with HELP or TYPE describe a metric.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The grammar of the format.
_NAME = "[a-zA-Z_:][a-zA-Z0-9_:]*+"
_LABEL = "[a-zA-Z_][a-zA-Z0-9_]*+"
# Possessive, so that long values need no stack.
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PAIR = rf"({_LABEL})[ \t]*+=[ \t]*+({_QUOTED})"
_PAIRS = rf"{_LABEL}[ \t]*+=[ \t]*+{_QUOTED}[ \t]*+"
_LABELS = rf"(?:\{{[ \t]*+((?:{_PAIRS}(?:,[ \t]*+{_PAIRS})*+,?[ \t]*+)?+)\}})?"
_SAMPLE = rf"(?s)^[ \t]*+({_NAME})[ \t]*+{_LABELS}[ \t]*+(?<=[ \t}}])([^ \t]++)(?:[ \t]++(-?[0-9]++))?[ \t\r]*+$"
_ABOUT = rf"(?s)^[ \t]*+#[ \t]++(HELP|TYPE)[ \t]++({_NAME})(?:[ \t]++(.*))?$"


def _unescaped(text: Column, quote: bool) -> Column:
    """Backslash sequences as what they stand for. What is between escaped backslashes is taken by itself."""
    part = lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))
    both = (lambda p: F.replace(part(p), F.lit('\\"'), F.lit('"'))) if quote else part
    return F.array_join(F.transform(F.split(text, r"\\\\"), both), "\\")


def _labels(text: Column) -> Column:
    """Label pairs as a map; of a name that is there twice the first value."""
    names = F.regexp_extract_all(text, F.lit(_PAIR), F.lit(1))
    values = F.transform(F.regexp_extract_all(text, F.lit(_PAIR), F.lit(2)), lambda v: _unescaped(F.substr(v, F.lit(2), F.length(v) - 2), True))
    different = F.array_distinct(names)
    first = F.transform(different, lambda n: F.element_at(values, F.array_position(names, n).cast("int")))
    return F.map_from_arrays(different, first)


def is_sample(line: Column) -> Column:
    """Neither empty nor a comment."""
    return line.rlike(r"^[ \t]*+[^# \t\r]")


def sample(line: Column) -> Column:
    """``metric, labels, value, ts, error`` of a sample line; ``error`` says why the others are NULL.

    ``ts`` is NULL where the line has none. Values are numbers, ``NaN``, ``+Inf`` or ``-Inf``.
    """
    # One match for all fields, so that the line is read once; labels are last, as they may hold anything.
    fields = F.split(F.regexp_replace(line, _SAMPLE, "$1\u0001$3\u0001$4\u0001$2"), "\u0001", 4)
    fits = line.rlike(_SAMPLE)
    field = lambda i: F.get(fields, F.lit(i))
    value, millis = field(1).try_cast("double"), field(2).try_cast("bigint")
    fine = fits & value.isNotNull() & ((field(2) == "") | millis.isNotNull())
    wrong = F.when(~fits, "not a sample").when(value.isNull(), "not a number").otherwise("not a time")
    return F.struct(
        F.when(fine, field(0)).alias("metric"),
        F.when(fine, _labels(field(3))).alias("labels"),
        F.when(fine, value).alias("value"),
        F.when(fine & (field(2) != ""), F.timestamp_millis(millis)).alias("ts"),
        F.when(~fine, wrong).alias("error"),
    )


def about(line: Column) -> Column:
    """``kind`` (``HELP`` or ``TYPE``), ``metric`` and ``text`` of a comment that describes a metric, else NULL."""
    field = lambda i: F.regexp_extract(line, _ABOUT, i)
    text = F.when(field(1) == "HELP", _unescaped(field(3), False)).otherwise(F.trim(field(3)))
    return F.when(line.rlike(_ABOUT), F.struct(field(1).alias("kind"), field(2).alias("metric"), text.alias("text")))


def exposed(metric: Column, labels: Column, value: Column, ts: Column | None = None) -> Column:
    """A sample as a line of the format."""
    escaped = lambda v: F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    pairs = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"')))
    names = F.when(F.size(labels) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    number = F.when(F.isnan(value), "NaN").when(value == float("inf"), "+Inf").when(value == float("-inf"), "-Inf").otherwise(value.cast("string"))
    line = F.concat(metric, names, F.lit(" "), number)
    return line if ts is None else F.concat(line, F.lit(" "), F.unix_millis(ts).cast("string"))

"""Names, sizes, previews and fixed formats."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Suffixes of files that are scored, and of objects that are previewed.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".webp")
PREVIEW_TEXT_SUFFIXES = (".txt", ".csv", ".json")
PREVIEW_IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg")
PREVIEW_CHARS = 500
LOG_TAIL_CHARS = 1024


def has_suffix(path: Column, suffixes: Sequence[str], ignore_case: bool = False) -> Column:
    """True when ``path`` ends with one of ``suffixes``."""
    if not ignore_case:
        return reduce(Column.__or__, [path.endswith(s) for s in suffixes])
    # The flag covers ASCII letters, which is all that suffixes have, and spares a lower-cased copy of each path.
    return F.rlike(path, F.lit(f"(?i)({'|'.join(map(re.escape, suffixes))})\\z"))


def is_image(path: Column, suffixes: Sequence[str] = IMAGE_SUFFIXES) -> Column:
    return has_suffix(path, suffixes, ignore_case=True)


def suffix_glob(suffixes: Sequence[str] = IMAGE_SUFFIXES) -> str:
    """The same test as a glob for the scan, so that other files are never opened."""
    spelled = ("".join(f"[{c.lower()}{c.upper()}]" for c in s.lstrip(".")) for s in suffixes)
    return "*.{" + ",".join(spelled) + "}"


def preview_kind(key: Column) -> Column:
    """``text``, ``image`` or ``none``; this test is case-sensitive."""
    return (
        F.when(has_suffix(key, PREVIEW_TEXT_SUFFIXES), "text")
        .when(has_suffix(key, PREVIEW_IMAGE_SUFFIXES), "image")
        .otherwise("none")
    )


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def fixed4(value: Column) -> Column:
    """Four decimals as text, half-even on the decimal value."""
    return F.bround(value.cast("decimal(38,18)"), 4).cast("decimal(38,4)").cast("string")


def size_kb(length: Column) -> Column:
    """Bytes as ``n.n KB``, half-even as in a fixed one-decimal format."""
    return F.concat(F.bround((length / 1024).cast("decimal(30,10)"), 1).cast("decimal(30,1)").cast("string"), F.lit(" KB"))


def text_preview(content: Column, chars: int = PREVIEW_CHARS) -> Column:
    """First characters of strictly decoded UTF-8, NULL where the bytes are not UTF-8."""
    return F.substring(F.try_validate_utf8(content.cast("string")), 1, chars)


def log_tail(log: Column, chars: int = LOG_TAIL_CHARS) -> Column:
    return F.right(log, F.lit(chars))

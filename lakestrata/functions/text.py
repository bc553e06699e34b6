"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def title_trim(col: Column) -> Column:
    """Trimmed text in title case."""
    return F.initcap(F.trim(col))


def trimmed_or(col: Column, default: str) -> Column:
    """Trimmed text, or the default when missing."""
    return F.trim(F.coalesce(col, F.lit(default)))


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.trim(col) == "")


def is_untrimmed(col: Column) -> Column:
    return col != F.trim(col)


def folded(col: Column) -> Column:
    """Text in the form used to compare case-insensitively."""
    return F.upper(F.trim(col))


def piped_key(*cols: Column) -> Column:
    """Values joined by a pipe, NULL shown as empty text (so NULL and '' are the same key)."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])

"""Column-level helpers (scalar functions).  All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodlake.functions.params import ARTIST_SEPARATOR, HASH_SEPARATOR

# Every character Python's str.strip() removes (the rule: chr(c).isspace()).
# Spark's trim() removes blanks only, so names are trimmed with this set.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

NULL_TEXT = "<null>"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN compares greater than every number in Spark; pandas treats it as
    missing.  Map NaN to null once so comparisons behave like missing data."""
    c = col_(c)
    return F.when(~F.isnan(c), c)  # keeps the column's own type; null stays null


def clip01(c: str | Column) -> Column:
    return F.least(F.greatest(col_(c), F.lit(0.0)), F.lit(1.0))


def strip_ws(c: str | Column) -> Column:
    """Python-style strip of all white space at both ends."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def split_artists(c: str | Column) -> Column:
    """`a;b ; c` -> array of raw (untrimmed) names."""
    return F.split(col_(c), ARTIST_SEPARATOR)


def first_artist(c: str | Column) -> Column:
    """First name in the artist list, trimmed; null when the list is null."""
    return strip_ws(F.get(split_artists(c), 0))


def text_or_sentinel(c: str | Column) -> Column:
    """Nulls become a visible sentinel so a separator join keeps field positions."""
    return F.coalesce(col_(c).cast("string"), F.lit(NULL_TEXT))


def row_hash(*cols: str | Column) -> Column:
    """md5 over `a||b||c` with nulls kept as a sentinel (concat_ws would drop them)."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[text_or_sentinel(c) for c in cols]))


def ts_text(c: str | Column) -> Column:
    """Stable text form of a timestamp used inside surrogate keys."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def surrogate_key(*parts: str | Column) -> Column:
    """md5 of parts joined by `_`."""
    return F.md5(F.concat_ws("_", *[col_(p).cast("string") for p in parts]))



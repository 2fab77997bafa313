"""Scalar Column helpers (all JVM-side built-ins, code-generated)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's filters.
NULL_TOKENS = ("null", "")
ITEM_SENTINEL = "(not set)"
USER_SENTINEL = "undefined"


def valid_token(c: Column | str, extra: tuple[str, ...] = ()) -> Column:
    """``c IS NOT NULL AND c NOT IN ('null', '', *extra)``."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNotNull() & ~col.isin(*NULL_TOKENS, *extra)


def ws_trim(c: Column | str) -> Column:
    """Strip all leading/trailing whitespace (Spark's ``trim`` strips spaces only)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def normalized_query(c: Column | str) -> Column:
    """``LOWER(TRIM(q))``."""
    return F.lower(ws_trim(c))


def parse_day(c: Column | str) -> Column:
    """``YYYYMMDD`` string to DATE (raises on malformed input under ANSI)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_date(col, "yyyyMMdd")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero or NULL divisor."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def md5_u60(c: Column) -> Column:
    """First 60 bits of ``md5(c)`` as a non-negative bigint (portable to SQL engines)."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")

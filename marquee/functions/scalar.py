"""Scalar Column helpers. All are built-in Spark expressions (JVM, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (input conventions of the reports):
NULL_SENTINEL = "\\N"          # the two characters backslash, N
YEAR_PATTERN = "^[0-9]{4}$"    # a year written as exactly four digits


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_sentinel(c: str | Column, sentinel: str = NULL_SENTINEL) -> Column:
    """NULL where the text equals the sentinel, else the value unchanged."""
    c = _col(c)
    return F.when(c == F.lit(sentinel), F.lit(None)).otherwise(c)


def safe_cast(c: str | Column, data_type: str) -> Column:
    """Cast that yields NULL on malformed input instead of failing (ANSI-safe)."""
    return _col(c).try_cast(data_type)


def to_int(c: str | Column) -> Column:
    """Text or number to int; sentinel and malformed text become NULL."""
    return safe_cast(null_if_sentinel(_col(c).cast("string")), "int")


def is_year_text(c: str | Column) -> Column:
    """True when the value, as text, is exactly four digits."""
    return _col(c).cast("string").rlike(YEAR_PATTERN)


def split_packed(c: str | Column, sep: str = ",") -> Column:
    """Split a packed multi-value text on a literal separator (empty parts kept)."""
    pattern = "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)
    return F.split(_col(c), pattern)


def year_of(c: str | Column) -> Column:
    return F.year(_col(c))


def month_key(c: str | Column) -> Column:
    """yyyymm as int, e.g. 1997-03-14 -> 199703."""
    c = _col(c)
    return F.year(c) * 100 + F.month(c)

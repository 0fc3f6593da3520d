"""Row filters and column shaping used before the reports."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import NULL_SENTINEL, null_if_sentinel, safe_cast


def all_of(conditions: Iterable[Column]) -> Column:
    conditions = list(conditions)
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def drop_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is non-NULL."""
    return df.filter(all_of(F.col(c).isNotNull() for c in columns))


def keep_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Keep rows whose column (as text) matches a Java regular expression."""
    return df.filter(F.col(column).cast("string").rlike(pattern))


def nullify_sentinels(df: DataFrame, columns: Iterable[str],
                      sentinel: str = NULL_SENTINEL) -> DataFrame:
    """Replace a text sentinel (default ``\\N``) by NULL in the given columns."""
    return df.withColumns({c: null_if_sentinel(c, sentinel) for c in columns})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns with NULL on malformed values (never fails under ANSI)."""
    return df.withColumns({c: safe_cast(c, t) for c, t in types.items()})


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns that exist; missing names are ignored."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def first_wins(column_lists: Iterable[Iterable[str]]) -> list[list[str]]:
    """For each input's columns, the ones kept when duplicate names keep the first."""
    seen: set[str] = set()
    kept: list[list[str]] = []
    for cols in column_lists:
        mine = []
        for c in cols:
            if c not in seen:
                seen.add(c)
                mine.append(c)
        kept.append(mine)
    return kept

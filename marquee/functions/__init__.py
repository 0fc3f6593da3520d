"""Scalar Column helpers."""

from marquee.functions.scalar import (NULL_SENTINEL, YEAR_PATTERN, is_year_text, month_key,
                                      null_if_sentinel, safe_cast, split_packed, to_int, year_of)

__all__ = ["NULL_SENTINEL", "YEAR_PATTERN", "is_year_text", "month_key", "null_if_sentinel",
           "safe_cast", "split_packed", "to_int", "year_of"]

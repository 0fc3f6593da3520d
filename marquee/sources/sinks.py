"""Result sinks: previews and write-once outputs."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame

from marquee.sources.delimited import Profile, read_delimited, write_delimited


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows (of a sorted result: the top ``n``), as a DataFrame."""
    return df.limit(n)


def write_then_preview(df: DataFrame, path: str, profile: Profile, n: int = 20,
                       order_by: Sequence[str | Column] = (),
                       mode: str = "errorifexists") -> DataFrame:
    """Write ``df`` once, then preview ``n`` rows read back from the written files.

    Showing a result and then writing it runs the whole plan twice; reading
    the preview from the output costs a scan of the (small) result instead.
    Pass ``order_by`` to get the top ``n`` in that order (a top-k, not a sort).
    """
    write_delimited(df, path, profile, mode=mode)
    back = read_delimited(df.sparkSession, path, profile, schema=df.schema)
    return back.orderBy(*order_by).limit(n) if order_by else back.limit(n)

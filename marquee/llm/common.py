"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir

# Fixed value: a word is a run of characters other than the six ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the session's shared checkpoint folder.

    Reliable ``checkpoint()``: every executor can read it, so a lost executor
    costs a re-read and no recomputation of what led here.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def at_most(rows: DataFrame, n: int, per: str | None = None) -> DataFrame:
    """``rows`` as they are, or the ``n`` first by a hash of the row where there are more (of a value of ``per``).

    Only hashes and row numbers are ranked; of equal rows, any.
    """
    count = F.count(F.lit(1)).alias("n")
    most = rows.agg(count) if per is None else rows.groupBy(per).agg(count).agg(F.max("n").alias("n"))
    if (most.first()["n"] or 0) <= n:
        return rows
    group, hashed, number = "at_most_group", "at_most_hash", "at_most_row"
    marked = rows.select("*", F.lit(0).alias(group) if per is None else F.col(per).alias(group),
                         F.xxhash64(*rows.columns).alias(hashed), F.monotonically_increasing_id().alias(number))
    first = Window.partitionBy(group).orderBy(hashed, number)
    last = (marked.select(group, hashed, number).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= n)
            .groupBy(F.col(group).alias("g")).agg(F.max(F.struct(hashed, number)).alias("last")))
    return (marked.join(F.broadcast(last), F.col(group) == F.col("g"))
            .where(F.struct(hashed, number) <= F.col("last")).select(*rows.columns))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def md5_number(text: Column) -> Column:
    """60-bit non-negative integer of a string, the same in every SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def utf8_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row of a string column; null reads as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def str_rows(column: pa.Array) -> list[str]:
    """Text of each row; null reads as empty."""
    return [v or "" for v in column.to_pylist()]


def groups_by_size(sizes: list[int], limit: int):
    """Consecutive index ranges ``(lo, hi)`` whose sizes add up to about ``limit``.

    A row larger than the limit gets a range of its own and is worked on in
    ``pieces``, so that vectorised work has bounded scratch memory whatever a
    batch holds.
    """
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def cut_at_blanks(text: str, limit: int, lo: int = 0) -> int:
    """Where to end a piece of ``text`` that starts at ``lo``: at a blank near ``limit`` characters on.

    The last blank within the limit, else the first one after it, else the end:
    no word is cut, however long.
    """
    if len(text) - lo <= limit:
        return len(text)
    at = max(text.rfind(" ", lo + 1, lo + limit), text.rfind("\n", lo + 1, lo + limit))
    if at < 0:
        found = re.compile(r"\s").search(text, lo + limit)
        at = found.start() if found else len(text)
    return at


def pieces(text: str, limit: int):
    """``text`` in consecutive pieces of about ``limit`` characters, cut at blanks."""
    lo = 0
    while True:
        hi = cut_at_blanks(text, limit, lo)
        yield text[lo:hi]
        if hi == len(text):
            return
        lo = hi


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit of a uint64 array over all output bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))

"""Side-by-side concatenation of tables by row position.

Row i of every input lands on output row i; shorter inputs are padded with
NULLs, and when inputs share a column name the first input's column wins.
Position is a row's place in the input: for files, by file path, then by the
split's place in the file, then by the row's place in its split; for any other
DataFrame, by partition and place in it. An explicit sort order per input
replaces it.

Positions are counted, not sorted, for inputs in input order: Spark gives the
rows of a split (for other DataFrames, of a partition) consecutive running ids
(``monotonically_increasing_id``), so a row's position is the rows of all
earlier splits, plus its running id, less the smallest running id of its split.
Rows per split and that smallest id are counted first: one row a split. A plain
read of files is read twice for that, each time with the same splits; any other
DataFrame is checkpointed first, so that both passes see the same partitions.

With an explicit order the input is range-partitioned and sorted by it (the
place in the input breaks ties, so even a key shared by many rows is split) and
checkpointed; positions are counted per partition in the same way. The inputs
are then full-outer-joined on position, a 1:1 key without skew. Nothing goes
through Python or into one task.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from marquee.operators.clean import all_of, first_wins
from marquee.session import checkpoint_dir

POSITION = "_position"


def _is_plain_read(df: DataFrame) -> bool:
    """Is ``df`` one scan of files, with nothing that moves rows between tasks?

    Its plan then deals out the same splits each time it is run.
    """
    nodes = re.findall(r"^[\s:+\-|]*(?:\*\(\d+\) )?([A-Z]\w+)", df._jdf.queryExecution().sparkPlan().toString(),
                       re.MULTILINE)
    return nodes.count("FileScan") == 1 and set(nodes) <= {"FileScan", "Project", "Filter", "ColumnarToRow"}


def _counted_positions(placed: DataFrame, part: Sequence[str], columns: Sequence[str], index_col: str) -> DataFrame:
    """Positions of rows whose ``_mid`` are consecutive within ``part`` (in the order of ``part``)."""
    sizes = placed.groupBy(*part).agg(F.count(F.lit(1)).alias("_rows"), F.min("_mid").alias("_first"))
    # One row a split or partition; the window adds up that many numbers.
    starts = sizes.select(*[F.col(c).alias(f"{c}_of") for c in part], "_first",
                          (F.sum("_rows").over(Window.orderBy(*part)) - F.col("_rows")).alias("_start"))
    same = all_of(F.col(c) == F.col(f"{c}_of") for c in part)
    return (placed.join(F.broadcast(starts), same)
            .select(*[F.col(f"`{c}`") for c in columns],
                    (F.col("_start") + F.col("_mid") - F.col("_first")).alias(index_col)))


def _with_place(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns that order it as its input: file, split in the file, running id."""
    row = F.monotonically_increasing_id().alias("_mid")
    if not _is_plain_read(df):
        return df.select("*", row), []
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_split"), row), ["_file", "_split"]


def positional_index(df: DataFrame, order_by: Sequence[str | Column] | None = None,
                     index_col: str = POSITION) -> DataFrame:
    """``df`` plus a 0-based, gap-free ``index_col`` following ``order_by`` (default: input order)."""
    checkpoint_dir(df.sparkSession)
    placed, place = _with_place(df)
    if place and not order_by:
        return _counted_positions(placed, place, df.columns, index_col)
    if order_by:
        # The place in the input breaks ties last: the sort key becomes unique, so
        # the range partitioner can split a key shared by many rows (copies), and
        # tied rows keep their input order.
        df = placed.orderBy(*order_by, *place, "_mid").select(*[F.col(f"`{c}`") for c in df.columns])
    tagged = df.select("*", F.spark_partition_id().alias("_part"),
                       F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    return _counted_positions(tagged, ["_part"], df.columns, index_col)


def concat_columns(dfs: Sequence[DataFrame],
                   order_by: Sequence[Sequence[str | Column] | None] | None = None) -> DataFrame:
    """Concatenate tables side by side by row position (see module doc).

    ``order_by``: a sort order per input; None (for one or for all) keeps input order.
    """
    if not dfs:
        raise ValueError("nothing to concatenate")
    order_by = [None] * len(dfs) if order_by is None else order_by
    if len(order_by) != len(dfs):
        raise ValueError("one sort order per input is required")
    kept = first_wins(d.columns for d in dfs)
    # An input that is sorted or checkpointed runs an independent job: submit them
    # from a few driver threads so Spark can run them side by side.
    with ThreadPoolExecutor(max_workers=min(8, len(dfs))) as pool:
        # Jobs from the pool keep the caller's job group, description and pool.
        index_one = inheritable_thread_target(dfs[0].sparkSession)(
            lambda args: positional_index(args[0], args[1]).select(POSITION, *args[2]))
        indexed = list(pool.map(index_one, zip(dfs, order_by, kept)))
    combined = reduce(lambda a, b: a.join(b, POSITION, "full_outer"), indexed)
    out_cols = [c for cols in kept for c in cols]
    return combined.orderBy(POSITION).select(*out_cols)

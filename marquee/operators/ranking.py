"""Ranking: top-N per group with ties, and global top-k.

``rank()`` gives tied rows one rank and leaves gaps after them, so a group can
return more than n rows. A textbook window sorts a whole group in one task, and
all rows that tie with it; both forms here work on values instead of rows:

``top_n_per_group``  ranks come from the n best *rows* of each group
    (``row_number() <= n``, planned as a partial ``WindowGroupLimit`` in every
    map task: at most n rows per group and task are shuffled, however many
    tie). A row qualifies exactly when its value is at least the n-th best
    row's, and every row that beats such a value is among those n, so ranks
    within them are the true ranks. At most n rows a group are joined back.
``rank_within``  every row's rank, as one more than the rows of its group with
    a better value, by distributed prefix counts: rows are counted per (group,
    value) with partial aggregation; the counts are range-partitioned by group
    and value, so that a group, however large, is cut into bins of consecutive
    values; a bin's values are ranked inside the bin, from the sum of the bins
    before it (one row a bin and group).

The first is lazy; the second checkpoints the counts, since the borders of the
bins are drawn from a sample and both readers must see the same bins. The size of
the joined side decides the join at run time (adaptive execution broadcasts a
small one and splits a (group, value) key that holds a large share of the rows).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir


def _ordering(value: str, descending: bool) -> Column:
    c = F.col(value)
    # Spark's defaults: DESC puts NULLs last, ASC puts them first.
    return c.desc_nulls_last() if descending else c.asc_nulls_first()


def _join_ranks(df: DataFrame, ranks: DataFrame, group: str, value: str, rank_col: str) -> DataFrame:
    side = ranks.toDF("_g", "_v", rank_col)
    cond = df[group].eqNullSafe(side["_g"]) & df[value].eqNullSafe(side["_v"])
    return df.join(side, cond, "inner").drop("_g", "_v")


def prefix_counts(counts: DataFrame, group: str, value: str, descending: bool, n: str, out: str,
                  bins: int | None = None) -> DataFrame:
    """``counts`` (one row a group and value) with the sum of ``n`` over the better values of its group.

    No task holds a group: bins of consecutive (group, value) are added up each
    by itself, then each starts from the sum of those before it. ``bins``:
    number of range partitions (default: the session's shuffle partitions).
    """
    checkpoint_dir(counts.sparkSession)
    order = _ordering(value, descending)
    cut = [F.col(group).asc_nulls_first(), order]
    binned = (counts.repartitionByRange(*([bins] if bins else []), *cut)
              .withColumn("_bin", F.spark_partition_id()).checkpoint(eager=True))
    whole = binned.groupBy(group, "_bin").agg(F.sum(n).alias("_in_bin"))
    before = Window.partitionBy(group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select(F.col(group).alias("_g"), F.col("_bin").alias("_b"),
                          F.coalesce(F.sum("_in_bin").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_bin").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("_inside", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    same = placed[group].eqNullSafe(starts["_g"]) & (placed["_bin"] == starts["_b"])
    return (placed.join(starts, same).withColumn(out, F.col("_inside") + F.col("_start"))
            .select(*counts.columns, out))


def rank_within(df: DataFrame, group: str, value: str, descending: bool = True,
                rank_col: str = "rank", bins: int | None = None) -> DataFrame:
    """Add ``rank()`` of ``value`` within ``group`` (ties share a rank, then gaps)."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_counts(counts, group, value, descending, "_n", "_better", bins)
    rank = (F.col("_better") + 1).cast("int").alias(rank_col)
    return _join_ranks(df, placed.select(group, value, rank), group, value, rank_col)


def top_n_by_rank(df: DataFrame, group: str, value: str, n: int, descending: bool = True,
                  rank_col: str = "rank") -> DataFrame:
    """The rows of ``top_n_per_group`` in one scan and without a join back.

    ``rank() <= n`` is planned as a group limit in every map task: what is
    shuffled is each task's n best rows a group and those that tie with them. Use
    it where ties of the n-th value are few or wanted in one task.
    """
    w = Window.partitionBy(group).orderBy(_ordering(value, descending))
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= n)


def value_ranks(df: DataFrame, group: str, value: str, n: int, descending: bool = True,
                rank_col: str = "rank") -> DataFrame:
    """(group, value, rank) for every distinct value whose rank is <= n."""
    w = Window.partitionBy(group).orderBy(_ordering(value, descending))
    best_rows = (df.select(group, value)
                 .withColumn("_pos", F.row_number().over(w))
                 .filter(F.col("_pos") <= n))
    # Already clustered by group: the rank window and the distinct need no
    # further shuffle.
    return (best_rows.withColumn(rank_col, F.rank().over(w))
            .select(group, value, rank_col).distinct())


def top_n_per_group(df: DataFrame, group: str, value: str, n: int, descending: bool = True,
                    rank_col: str = "rank") -> DataFrame:
    """Rows with ``rank() <= n`` of ``value`` within ``group``, plus the rank column."""
    return _join_ranks(df, value_ranks(df, group, value, n, descending, rank_col), group, value, rank_col)


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First k rows in the given order (planned as a single top-k, no full sort)."""
    return df.orderBy(*order).limit(k)

"""Equi-joins used by the reports.

Physical strategy is Spark's: a side whose estimated (static stats) or
measured (AQE, after its shuffle stage) size is under the broadcast threshold
is broadcast, anything larger goes through a sort-merge join, and AQE splits
skewed partitions of inner joins. Explicit broadcasts appear only where a
side is bounded by construction (see ``ranking`` and ``concat``).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.clean import all_of


def join_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
            how: str = "inner") -> DataFrame:
    """Join on ``left.a == right.b`` for every ``(a, b)`` pair; both key columns kept.

    Several pairs form a composite key (all must match); every pair is an
    equality, so Spark hash-partitions on all of them.
    """
    cond = all_of(left[a] == right[b] for a, b in pairs)
    return left.join(right, cond, how)


def full_outer_counts(left: DataFrame, right: DataFrame, key: str,
                      fill_columns: Iterable[str], fill: int = 0) -> DataFrame:
    """Full outer join on a same-named key (emitted once) with 0 for missing counts.

    The key is compared null-safely, so rows without a key of either side share
    one row. Only the count columns are filled: a NULL key stays NULL rather
    than becoming a fake key 0.
    """
    other = right.withColumnRenamed(key, "_right_key")
    joined = left.join(other, left[key].eqNullSafe(other["_right_key"]), "full_outer")
    merged = joined.withColumn(key, F.coalesce(left[key], other["_right_key"])).drop("_right_key")
    return merged.fillna(fill, subset=list(fill_columns))

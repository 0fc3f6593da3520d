"""Means that do not depend on the order of rows, and reports rolled up from shared states.

A double sum changes in its last digits with the order in which tasks finish.
Here values are added as decimals (``EXACT``), which is associative, and the mean
is one division at the end, so any partitioning gives the same digits. A value
without such a form (not a number, infinite, 10^20 or more) counts as NULL.

``mean_states`` holds, per key, the exact sum and the two counts from which any
coarser mean follows; decade and era reports are rolled up from the states by
year and genre instead of reading the rows again. Reports over one states
DataFrame share its exchange when they run in one query; to share it between
queries, checkpoint the states and pass them on.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.aggregates import bucket_expr

EXACT = "DECIMAL(38, 18)"
SUM, RATED, ROWS = "value_sum", "value_n", "row_n"  # columns of the states


def exact(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).try_cast(EXACT)


def exact_mean(value: str | Column, where: Column | None = None) -> Column:
    """Mean over a group, the same for every order of its rows; NULL if no value counts."""
    v = exact(value) if where is None else F.when(where, exact(value))
    return F.try_divide(F.sum(v).cast("double"), F.count(v))


def mean_states(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key combination (NULL is a key): exact sum and count of the value, and rows."""
    v = exact(value)
    return df.groupBy(*keys).agg(F.sum(v).alias(SUM), F.count(v).alias(RATED), F.count(F.lit(1)).alias(ROWS))


def _mean(where: Column | None = None) -> Column:
    part = (lambda c: F.col(c)) if where is None else (lambda c: F.when(where, F.col(c)))
    return F.try_divide(F.sum(part(SUM)).cast("double"), F.sum(part(RATED)))


# Every rollup looks at all three columns of the states, and filters only above its own
# grouping: so the states below it are the same plan in every report, and are run once.
def _any_rows() -> Column:
    return F.sum(ROWS).alias(ROWS)


def stats_of_states(states: DataFrame, keys: Sequence[str], avg_name: str, count_name: str) -> DataFrame:
    """Mean and rows per key of the states; sorted like ``group_stats``."""
    mean = F.try_divide(F.col(SUM).cast("double"), F.col(RATED))
    return (states.select(*keys, mean.alias(avg_name), F.col(ROWS).alias(count_name))
            .orderBy(F.col(keys[0]).asc(), F.col(avg_name).desc(), *[F.col(k).asc() for k in keys[1:]]))


def bucket_of_states(states: DataFrame, column: str, width: int, mode: str, bucket: str, out: str) -> DataFrame:
    """Mean per fixed-width bucket of a key of the states; sorted by bucket."""
    rolled = states.groupBy(bucket_expr(column, width, mode).alias(bucket)).agg(_mean().alias(out), _any_rows())
    return rolled.where(F.col(ROWS) > 0).select(bucket, out).orderBy(bucket)


def era_of_states(states: DataFrame, group: str, time_col: str, split_at, before: str, after: str,
                  change: str) -> DataFrame:
    """Mean before and from ``split_at`` per group of the states; like ``era_change``."""
    t = F.col(time_col)
    named = F.max(F.col(group).isNotNull()).alias("named")  # an aggregate: the filter on it stays up here
    rolled = states.groupBy(group).agg(_mean(t < split_at).alias(before), _mean(t >= split_at).alias(after),
                                       named, _any_rows())
    kept = F.col("named") & (F.col(ROWS) > 0) & F.col(before).isNotNull() & F.col(after).isNotNull()
    return (rolled.where(kept).select(group, before, after, (F.col(after) - F.col(before)).alias(change))
            .orderBy(F.col(change).desc(), F.col(group).asc()))

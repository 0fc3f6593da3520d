"""Grouped aggregates behind the reports.

Every aggregate here (count, sum, avg, conditional avg) is algebraic, so Spark
runs it as partial aggregation before the shuffle and final aggregation after
it: a hot group key is collapsed to one row per map task before it is sent
anywhere, and the shuffle carries at most (#groups x #map tasks) rows.
``avg_by_packed_key`` and ``score_by_label`` also reduce the fact rows per join
key before the join; ``avg_by_key`` cannot without a second exchange of them
(its groups are not the join key); a hot key is left to the skew-join split or,
on request, dealt out by ``heavy.split_join``.
"""

from __future__ import annotations

from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.scalar import split_packed
from marquee.operators.clean import all_of
from marquee.operators.heavy import split_join
from marquee.operators.joins import full_outer_counts


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def count_by_key(df: DataFrame, key: str | Column, out: str, key_name: str | None = None) -> DataFrame:
    """Rows per key: ``key_name, out`` (bigint)."""
    k = F.col(key) if isinstance(key, str) else key
    name = key_name or (key if isinstance(key, str) else "key")
    return df.groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias(out))


def two_source_counts(left: DataFrame, right: DataFrame, key: str,
                      left_count: str, right_count: str) -> DataFrame:
    """Rows per key on each side, side by side; a key missing on one side counts 0.

    Both sides are reduced to one row per key before the join, so the full
    outer join only ever sees the (small) per-key counts. Sorted key desc.
    """
    l_counts = count_by_key(left, key, left_count)
    r_counts = count_by_key(right, key, right_count)
    return (full_outer_counts(l_counts, r_counts, key, [left_count, right_count])
            .orderBy(F.col(key).desc()))


def _join_cond(left: DataFrame, right: DataFrame, on: str | Sequence[tuple[str, str]]):
    """A same-named key as is (USING join), or the conjunction of key pairs."""
    return on if isinstance(on, str) else all_of(left[a] == right[b] for a, b in on)


def _keys_of(on: str | Sequence[tuple[str, str]], side: int) -> list[str]:
    return [on] if isinstance(on, str) else [pair[side] for pair in on]


def avg_by_key(parent: DataFrame, child: DataFrame, on: str | Sequence[tuple[str, str]],
               group: str, value: str, out: str = "avg_value", split_heavy: bool = False,
               mean: Callable[[str], Column] = F.avg) -> DataFrame:
    """Mean of a parent value per child group, across a 1:N parent-child join.

    A parent row counts once per matching child row (fan-out), exactly as if
    the join were materialised; NULL values are ignored and a group of only
    NULLs gets NULL. Sorted by group ascending.

    Plan: child rows are exchanged once, for the join; the mean is made by
    partial aggregation right above it, so only one row per group and task is
    shuffled after. A join key that holds a large share of the rows is split by
    adaptive execution's skew join, or, with ``split_heavy`` (key pairs only), by
    ``split_join``, at the price of one more scan of the child's keys. ``mean``: the
    aggregate (``rollup.exact_mean`` gives the same digits in any row order).
    """
    pairs = _keys_of(on, 1)
    if split_heavy:
        joined = split_join(child.select(*dict.fromkeys([*pairs, group])), parent, [(b, a) for a, b in on])
        return joined.groupBy(group).agg(mean(value).alias(out)).orderBy(group)
    joined = parent.join(child.select(*dict.fromkeys([*pairs, group])), _join_cond(parent, child, on), "inner")
    return joined.groupBy(group).agg(mean(value).alias(out)).orderBy(group)


def explode_packed(df: DataFrame, packed: str, sep: str, as_name: str) -> DataFrame:
    """One row per element of a packed multi-value text column (NULL text -> no row)."""
    return df.withColumn(as_name, F.explode(split_packed(packed, sep)))


def avg_by_packed_key(left: DataFrame, right: DataFrame, on: str | Sequence[tuple[str, str]],
                      packed: str, value: str, sep: str = ",", exclude: Iterable[str] = (),
                      group: str = "genre", out: str = "avg_value", exact: str | None = None) -> DataFrame:
    """Mean of ``value`` (from ``right``) per element of ``left``'s packed column.

    Same result as: join on ``on``, split ``packed`` on the literal ``sep``,
    one row per element, mean per element, then drop NULL and excluded
    elements. Sorted by element.

    Plan: ``right`` (the large, fact-like side) is first reduced to (sum,
    count) per join key with partial aggregation in each map task, so the
    join and the explode see one row per key instead of one per fact row, and
    a hot key cannot make one join task large. Excluded elements are
    filtered on the group key, which Catalyst applies below the aggregate.
    ``exact``: a decimal type to add the values in (see ``rollup``).
    """
    right_keys = _keys_of(on, 1)
    v = F.col(value) if exact is None else F.col(value).try_cast(exact)
    sums = right.groupBy(*right_keys).agg(F.sum(v).alias("_s"), F.count(v).alias("_n"))
    joined = left.join(sums, _join_cond(left, sums, on), "inner")
    exploded = explode_packed(joined, packed, sep, group).select(group, "_s", "_n")
    total = F.sum("_s") if exact is None else F.sum("_s").cast("double")
    means = exploded.groupBy(group).agg(F.try_divide(total, F.sum("_n")).alias(out))
    excluded = list(exclude)
    keep = F.col(group).isNotNull()
    if excluded:
        keep = keep & ~F.col(group).isin(excluded)
    return means.filter(keep).orderBy(group)


def group_stats(df: DataFrame, keys: Sequence[str], value: str,
                avg_name: str = "avg_value", count_name: str = "row_count") -> DataFrame:
    """Mean and row count per key combination; sorted by first key, mean desc.

    A NULL key forms its own group. Remaining keys break ties so the order is
    total.
    """
    keys = _keys(keys)
    return (df.groupBy(*keys)
            .agg(F.avg(value).alias(avg_name), F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(keys[0]).asc(), F.col(avg_name).desc(), *[F.col(k).asc() for k in keys[1:]]))


def bucket_expr(column: str, width: int = 10, mode: str = "floor") -> Column:
    """Bucket start: ``floor`` rounds down (-5 -> -10), ``trunc`` toward zero (-5 -> 0)."""
    c = F.col(column)
    # try-casts: a value beyond int range gets a NULL bucket, not a failed job.
    w = F.lit(width).cast("long")
    if mode == "floor":
        return F.try_multiply(F.floor(c / width), w).try_cast("int")
    if mode == "trunc":
        return F.try_multiply((c / width).try_cast("long"), w).try_cast("int")
    raise ValueError(f"unknown bucket mode {mode!r}")


def bucket_avg(df: DataFrame, column: str, value: str, width: int = 10, mode: str = "floor",
               bucket: str = "decade", out: str = "avg_value") -> DataFrame:
    """Mean of ``value`` per fixed-width bucket of ``column``; sorted by bucket."""
    return (df.groupBy(bucket_expr(column, width, mode).alias(bucket))
            .agg(F.avg(value).alias(out)).orderBy(bucket))


def era_change(df: DataFrame, group: str, time_col: str, split_at, value: str,
               before: str = "avg_before", after: str = "avg_after",
               change: str = "change") -> DataFrame:
    """Mean before and from ``split_at`` per group, and their difference.

    Groups lacking either era are dropped; NULL groups are dropped first.
    Sorted by change descending (group ascending breaks ties).
    """
    t, v = F.col(time_col), F.col(value)
    return (df.filter(F.col(group).isNotNull())
            .groupBy(group)
            .agg(F.avg(F.when(t < split_at, v)).alias(before),
                 F.avg(F.when(t >= split_at, v)).alias(after))
            .withColumn(change, F.col(after) - F.col(before))
            .filter(F.col(before).isNotNull() & F.col(after).isNotNull())
            .orderBy(F.col(change).desc(), F.col(group).asc()))


def score_by_group(df: DataFrame, keys: Sequence[str], rating: str, weight: str,
                   count_name: str = "row_count", avg_name: str = "avg_rating",
                   total_name: str = "total_weight", score_name: str = "score") -> DataFrame:
    """Per group: rows, mean rating, total weight and score = total weight x mean rating.

    The score is a product of two aggregates, not a sum of products.
    """
    keys = _keys(keys)
    total, rated = F.sum(weight), F.count(rating)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name), F.avg(rating).alias(avg_name),
                                 total.alias(total_name),
                                 F.try_divide(total * F.sum(rating), rated).alias(score_name))


# Mergeable partial state of ``score_by_group``: rows, sum and count of the
# rating (a mean is their ratio), and sum of the weight.
_P_ROWS, _P_RSUM, _P_RCNT, _P_WSUM = "_p_rows", "_p_rating_sum", "_p_rating_n", "_p_weight_sum"


def score_partials(df: DataFrame, keys: Sequence[str], rating: str, weight: str,
                   times: str | None = None) -> DataFrame:
    """Per-key partial state from which ``score_from_partials`` finishes the score.

    ``times``: a column saying how many equal rows a row stands for.
    """
    n = F.col(times) if times else F.lit(1)
    rated = F.when(F.col(rating).isNotNull(), n)
    return df.groupBy(*_keys(keys)).agg(F.sum(n).cast("bigint").alias(_P_ROWS),
                                        F.sum(F.col(rating) * n).alias(_P_RSUM),
                                        F.coalesce(F.sum(rated), F.lit(0)).cast("bigint").alias(_P_RCNT),
                                        F.sum(F.col(weight) * n).alias(_P_WSUM))


def score_from_partials(df: DataFrame, keys: Sequence[str], count_name: str = "row_count",
                        avg_name: str = "avg_rating", total_name: str = "total_weight",
                        score_name: str = "score", divide_as: str | None = None) -> DataFrame:
    """Combine partial states per key into the columns of ``score_by_group``.

    ``divide_as``: the type that the rating's sum is divided in (default: its own).
    """
    rating, rated, total = F.sum(_P_RSUM), F.sum(_P_RCNT), F.sum(_P_WSUM)
    rating = rating if divide_as is None else rating.cast(divide_as)
    return df.groupBy(*_keys(keys)).agg(F.sum(_P_ROWS).alias(count_name),
                                        F.try_divide(rating, rated).alias(avg_name), total.alias(total_name),
                                        F.try_divide(total * rating, rated).alias(score_name))


def score_by_label(df: DataFrame, group: str, id_col: str, labels: DataFrame, label_key: str,
                   label: str, rating: str, weight: str, label_name: str | None = None,
                   times: str | None = None, count_name: str = "row_count", avg_name: str = "avg_rating",
                   total_name: str = "total_weight", score_name: str = "score",
                   divide_as: str | None = None) -> DataFrame:
    """``score_by_group`` of ``df JOIN labels ON id_col = label_key`` by (group, label).

    Same result, cheaper plan: the rows are first reduced to one partial
    state per (group, id) -- partial aggregation runs before any shuffle --
    and only that small table is joined to the labels. States are then
    combined per (group, label), so ids sharing a label still form one group.
    """
    label_name = label_name or label
    partial = score_partials(df, [group, id_col], rating, weight, times)
    named = partial.join(labels.select(F.col(label_key).alias("_label_key"),
                                       F.col(label).alias(label_name)),
                         F.col(id_col) == F.col("_label_key"), "inner")
    return score_from_partials(named, [group, label_name], count_name, avg_name, total_name,
                               score_name, divide_as)

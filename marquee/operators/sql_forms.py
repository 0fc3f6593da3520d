"""The reports' operators as Spark SQL text, one builder each.

A builder takes relations (a table binding such as ``{orders}`` or any
parenthesised query) and column names, and returns a query for ``spark.sql``.
The film reports and their twins over the benchmark tables call the same
builders, so each report is defined once in each language. Plans follow the
DataFrame operators: reduce before joining, rank few rows, look names up last.
"""

from __future__ import annotations

from typing import Callable, Sequence

from marquee.operators.rollup import EXACT, RATED, ROWS, SUM


def plain_mean(value: str) -> str:
    return f"AVG({value})"


def exact_mean(value: str) -> str:
    """Mean with the same digits in any row order (see ``rollup``)."""
    return (f"try_divide(CAST(SUM(TRY_CAST({value} AS {EXACT})) AS DOUBLE), "
            f"COUNT(TRY_CAST({value} AS {EXACT})))")


def two_source_counts_sql(left: str, right: str, key: str, left_count: str, right_count: str) -> str:
    """Rows per key of two relations side by side, 0 where one has none.

    Each side is one row a key before the join. The join is null-safe: rows
    without a key are counted in one row with a NULL key, whichever side has them.
    """
    return f"""
        WITH l AS (SELECT {key}, COUNT(*) AS n FROM {left} GROUP BY {key}),
             r AS (SELECT {key}, COUNT(*) AS n FROM {right} GROUP BY {key})
        SELECT COALESCE(l.{key}, r.{key}) AS {key},
               COALESCE(l.n, 0L) AS {left_count}, COALESCE(r.n, 0L) AS {right_count}
        FROM l FULL OUTER JOIN r ON l.{key} <=> r.{key}
        ORDER BY {key} DESC"""


def avg_by_key_sql(parent: str, child: str, key: str, group: str, value: str, out: str,
                   mean: Callable[[str], str] = plain_mean) -> str:
    """Mean of a parent value per child group; each matching child row counts."""
    return f"SELECT {group}, {mean(value)} AS {out} FROM {parent} JOIN {child} USING ({key}) GROUP BY {group} ORDER BY {group}"


def avg_by_packed_key_sql(left: str, right: str, key: str, packed: str, value: str, sep: str,
                          excluded: str, group: str, out: str, exact: str | None = None) -> str:
    """Mean per element of a packed column, from sums (in the type ``exact``) made per key before the join."""
    value, total = (value, "SUM(total)") if exact is None else (
        f"TRY_CAST({value} AS {exact})", "CAST(SUM(total) AS DOUBLE)")
    return f"""
        WITH per_key AS (
            SELECT {key}, SUM({value}) AS total, COUNT({value}) AS n FROM {right} GROUP BY {key}
        )
        SELECT {group}, try_divide({total}, SUM(n)) AS {out}
        FROM (SELECT explode(split({packed}, '{sep}')) AS {group}, total, n
              FROM {left} JOIN per_key USING ({key}))
        WHERE {group} <> '{excluded}'
        GROUP BY {group}
        ORDER BY {group}"""


def group_stats_sql(rel: str, keys: Sequence[str], value: str, avg_name: str, count_name: str) -> str:
    """Mean and row count per key combination."""
    names = ", ".join(keys)
    return f"""
        SELECT {names}, AVG({value}) AS {avg_name}, COUNT(*) AS {count_name}
        FROM {rel} GROUP BY {names}
        ORDER BY {keys[0]}, {avg_name} DESC, {", ".join(keys[1:])}"""


def top_n_per_group_sql(rel: str, columns: Sequence[str], group: str, value: str, n: int, rank_col: str) -> str:
    """Rows of rank <= n; the rank filter reaches the map side as a group limit, so few rows are shuffled."""
    names = ", ".join(columns)
    return f"""
        SELECT {names}, {rank_col}
        FROM (SELECT {names}, RANK() OVER (PARTITION BY {group} ORDER BY {value} DESC) AS {rank_col} FROM {rel})
        WHERE {rank_col} <= {n}
        ORDER BY {group}, {rank_col}"""


def bucket_avg_sql(rel: str, column: str, value: str, width: int, bucket: str, out: str) -> str:
    """Mean per bucket of a column, buckets floored to multiples of ``width``."""
    return f"""
        SELECT FLOOR({column} / {width}) * {width} AS {bucket}, AVG({value}) AS {out}
        FROM {rel} GROUP BY {bucket} ORDER BY {bucket}"""


def era_change_sql(rel: str, group: str, time_col: str, split_at: int, value: str, before: str, after: str,
                   change: str) -> str:
    """Mean before and from ``split_at`` per group and their difference, by a pivot over the era."""
    return f"""
        SELECT {group}, {before}, {after}, {after} - {before} AS {change}
        FROM (SELECT {group}, {value} AS v, {time_col} >= {split_at} AS late FROM {rel} WHERE {group} IS NOT NULL)
             PIVOT (AVG(v) FOR late IN (false AS {before}, true AS {after}))
        WHERE {before} IS NOT NULL AND {after} IS NOT NULL
        ORDER BY {change} DESC, {group}"""


def split_means_sql(rel: str, group: str, condition: str, value: str, where_true: str, where_false: str,
                    kept: str) -> str:
    """Mean of ``value`` where ``condition`` holds and where it does not, side by side per group.

    ``kept`` is a condition on the two means, by their names; a mean of no rows is NULL.
    """
    return f"""
        SELECT {group},
               AVG(CASE WHEN {condition} THEN {value} END) AS {where_true},
               AVG(CASE WHEN NOT ({condition}) THEN {value} END) AS {where_false}
        FROM {rel} GROUP BY {group}
        HAVING {kept}
        ORDER BY {group}"""


def banded_stats_sql(rel: str, band: str, value: str, band_name: str, count_name: str, avg_name: str) -> str:
    """Rows and mean per band, where ``band`` is an expression: the grouping repeats it."""
    return f"""
        SELECT {band} AS {band_name}, COUNT(*) AS {count_name}, AVG({value}) AS {avg_name}
        FROM {rel} GROUP BY {band} ORDER BY {band_name}"""


def mean_states_sql(rel: str, keys: Sequence[str], value: str) -> str:
    """Exact sums and counts per key, from which coarser means are rolled up (``rollup.mean_states``)."""
    names = ", ".join(keys)
    return f"""
        SELECT {names}, SUM(TRY_CAST({value} AS {EXACT})) AS {SUM}, COUNT(TRY_CAST({value} AS {EXACT})) AS {RATED},
               COUNT(*) AS {ROWS}
        FROM {rel} GROUP BY {names}"""


def _rolled(where: str | None = None) -> str:
    def part(c):
        return c if where is None else f"IF({where}, {c}, NULL)"

    return f"try_divide(CAST(SUM({part(SUM)}) AS DOUBLE), SUM({part(RATED)}))"


def stats_of_states_sql(states: str, keys: Sequence[str], avg_name: str, count_name: str) -> str:
    """Mean and rows per key of the states."""
    names = ", ".join(keys)
    return f"""
        SELECT {names}, try_divide(CAST({SUM} AS DOUBLE), {RATED}) AS {avg_name}, {ROWS} AS {count_name}
        FROM {states}
        ORDER BY {keys[0]}, {avg_name} DESC, {", ".join(keys[1:])}"""


def bucket_of_states_sql(states: str, column: str, width: int, bucket: str, out: str) -> str:
    """Mean per floored bucket of a key of the states."""
    return f"""
        SELECT FLOOR({column} / {width}) * {width} AS {bucket}, {_rolled()} AS {out}
        FROM {states} GROUP BY {bucket} HAVING SUM({ROWS}) > 0 ORDER BY {bucket}"""


def era_of_states_sql(states: str, group: str, time_col: str, split_at: int, before: str, after: str,
                      change: str) -> str:
    """Mean before and from ``split_at`` per group of the states; the filters stay above the grouping."""
    return f"""
        SELECT {group}, {before}, {after}, {after} - {before} AS {change}
        FROM (SELECT {group}, MAX({group} IS NOT NULL) AS named, SUM({ROWS}) AS n,
                     {_rolled(f"{time_col} < {split_at}")} AS {before},
                     {_rolled(f"{time_col} >= {split_at}")} AS {after}
              FROM {states} GROUP BY {group})
        WHERE named AND n > 0 AND {before} IS NOT NULL AND {after} IS NOT NULL
        ORDER BY {change} DESC, {group}"""


def score_by_label_sql(rel: str, group: str, id_col: str, labels: str, label_key: str, label: str, rating: str,
                       weight: str, label_name: str, count_name: str, avg_name: str, total_name: str,
                       score_name: str, digits: int | None = None, times: str = "1",
                       divide_as: str | None = None) -> str:
    """Rows, mean rating, total weight and their product per (group, label of the id).

    One state per (group, id) is made before the labels are joined. With
    ``digits`` the mean and the score are rounded, each once. A row counts
    ``times`` (a column or 1). ``divide_as``: the type that the rating's sum is
    divided in (default: its own).
    """
    def shown(x: str) -> str:
        return x if digits is None else f"ROUND({x}, {digits})"

    rating_sum = "rating_sum" if divide_as is None else f"CAST(rating_sum AS {divide_as})"

    return f"""
        WITH state AS (
            SELECT {group}, {id_col}, SUM({times}) AS n, SUM({rating} * {times}) AS rating_sum,
                   SUM(IF({rating} IS NULL, 0, {times})) AS rated, SUM({weight} * {times}) AS weight_sum
            FROM {rel} GROUP BY {group}, {id_col}
        ),
        total AS (
            SELECT s.{group}, l.{label} AS {label_name}, SUM(s.n) AS n, SUM(s.rating_sum) AS rating_sum,
                   SUM(s.rated) AS rated, SUM(s.weight_sum) AS weight_sum
            FROM state s JOIN {labels} l ON s.{id_col} = l.{label_key}
            GROUP BY s.{group}, l.{label}
        )
        SELECT {group}, {label_name}, n AS {count_name}, {shown(f"try_divide({rating_sum}, rated)")} AS {avg_name},
               weight_sum AS {total_name}, {shown(f"try_divide(weight_sum * {rating_sum}, rated)")} AS {score_name}
        FROM total
        ORDER BY {score_name} DESC"""

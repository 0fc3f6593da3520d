"""DataFrame operators: cleaning, joins, aggregates, ranking, concatenation, profiling."""

from marquee.operators import sql_forms
from marquee.operators.aggregates import (avg_by_key, avg_by_packed_key, bucket_avg, bucket_expr,
                                          score_by_label, score_from_partials, score_partials,
                                          count_by_key, era_change, explode_packed, group_stats,
                                          score_by_group, two_source_counts)
from marquee.operators.clean import (all_of, cast_columns, drop_nulls, drop_present, first_wins,
                                     keep_matching, nullify_sentinels, rename_columns)
from marquee.operators.concat import concat_columns, positional_index
from marquee.operators.heavy import heavy_buckets, split_join
from marquee.operators.joins import full_outer_counts, join_on
from marquee.operators.profile import table_profile
from marquee.operators.ranking import (prefix_counts, rank_within, top_k, top_n_by_rank, top_n_per_group,
                                       value_ranks)
from marquee.operators.rollup import (EXACT, bucket_of_states, era_of_states, exact_mean, mean_states,
                                      stats_of_states)

__all__ = [
    "avg_by_key", "avg_by_packed_key", "bucket_avg", "bucket_expr", "count_by_key", "era_change",
    "explode_packed", "group_stats", "score_by_group", "score_by_label", "score_from_partials",
    "score_partials", "two_source_counts", "all_of",
    "cast_columns", "drop_nulls", "drop_present", "first_wins", "keep_matching",
    "nullify_sentinels", "rename_columns", "concat_columns", "positional_index",
    "sql_forms", "full_outer_counts", "join_on", "table_profile", "rank_within",
    "top_k", "top_n_per_group", "value_ranks", "heavy_buckets", "split_join", "prefix_counts",
    "top_n_by_rank", "EXACT", "bucket_of_states", "era_of_states", "exact_mean", "mean_states", "stats_of_states",
]

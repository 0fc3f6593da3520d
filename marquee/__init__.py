"""marquee: batch analytics over relational tables, built on Spark DataFrames.

Layout
------
sources/    delimited-text profiles, readers, writers, directory ingest, Parquet tables
functions/  scalar Column helpers (safe casts, sentinels, buckets, rounding)
operators/  cleaning, joins, aggregates, ranking, column concatenation, profiling
plans/      the four movie-analytics reports (DataFrame and SQL forms) and the
            bindings of every operator to the benchmark tables

Every function takes the caller's ``SparkSession`` (or DataFrames) and returns
lazy DataFrames; nothing is collected unless the function says so.
"""

__version__ = "0.1.0"

"""Shape of a set of tables: rows and columns per table."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _literal_map(pairs) -> F.Column:
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, row_count, column_count, column_names``.

    All tables are counted in one job: each scan only tags its rows with the
    table name (no columns are read; Parquet answers from footers), and one
    grouped count with map-side partial counts gives rows per table. A seed
    row of weight 0 per table keeps empty tables in the result. Column facts
    come from the schemas as literal lookups, so no join is needed.
    """
    if not tables:
        raise ValueError("no tables to profile")
    spark = next(iter(tables.values())).sparkSession
    seeds = spark.range(0, 1, 1, 1).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(0).alias("w")) for name in tables])))
    tagged = reduce(DataFrame.unionByName,
                    [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("w"))
                     for name, df in tables.items()], seeds)
    counts = tagged.groupBy("table_name").agg(F.sum("w").cast("bigint").alias("row_count"))
    n_cols = _literal_map((name, len(df.columns)) for name, df in tables.items())
    col_names = _literal_map((name, ",".join(df.columns)) for name, df in tables.items())
    return counts.select("table_name", "row_count",
                         n_cols[F.col("table_name")].alias("column_count"),
                         col_names[F.col("table_name")].alias("column_names"))

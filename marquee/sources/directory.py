"""Load every delimited file of a directory as its own table.

Listing goes through the Hadoop file system of the path, so it works wherever
Spark can read (HDFS, object stores, local) and starts no job. A directory entry is
either a plain file (``movies.csv``) or a folder of part files written by
Spark (``movies.csv/part-*.csv``); both load as one table named by the entry.
"""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from marquee.sources.delimited import PLAIN_CSV, Profile, read_by_header, read_delimited

# Columns the column-concatenation prep drops from the films file.
# Fixed values (must match the reports' expected input):
MOVIES_DROPPED_COLUMNS = ("description", "tagline", "minute")


def list_entries(spark: SparkSession, directory: str, suffix: str = ".csv") -> list[tuple[str, str]]:
    """Sorted ``(table_name, path)`` for each top-level entry ending in ``suffix``.

    Sorting by name makes the table order, and so column order of any
    positional combination, independent of the filesystem's listing order.
    Only the top level is listed: part files of a folder stay on the cluster.
    """
    root = directory.rstrip("/") or directory
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(status.getPath().getName() for status in found)
    return [(n[: -len(suffix)], f"{root}/{n}") for n in names
            if n.endswith(suffix) and not n.startswith(("_", "."))]


def read_directory(spark: SparkSession, directory: str, profile: Profile = PLAIN_CSV,
                   drop_columns: Mapping[str, tuple[str, ...]] | None = None,
                   infer: bool = True,
                   exclude: tuple[str, ...] = (),
                   schemas: Mapping[str, StructType] | None = None,
                   skipped: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Load each ``*.csv`` entry of ``directory`` into ``{table_name: DataFrame}``.

    drop_columns  per-table columns to drop when present (missing ones ignored).
    exclude       table names to skip, e.g. a previous combined output written
                  into the same directory, so a re-run never ingests itself.
    schemas       declared types by table name, bound by header name: such a
                  table is read without the inference pass over its data.
                  Rows keep their file's order, as those of inferred tables do.
    skipped       receives ``(table_name, reason)`` of every file left out.

    A file that Spark cannot understand as a table (an analysis or parse error,
    or no column at all) is left out with a warning that names it and says why.
    Anything else, such as a failed job, is raised, as is a directory without a
    matching or loadable file.
    """
    if drop_columns is None:
        drop_columns = {"movies": MOVIES_DROPPED_COLUMNS}
    entries = [e for e in list_entries(spark, directory) if e[0] not in exclude]
    if not entries:
        raise ValueError(f"no CSV files found in {directory}")

    def load(entry: tuple[str, str]) -> DataFrame | str:
        name, path = entry
        try:
            if schemas and name in schemas:
                df = read_by_header(spark, path, profile, schemas[name], splittable=False)
            else:
                df = read_delimited(spark, path, profile, infer=infer)
        except AnalysisException as error:  # ParseException is one too
            return str(error).splitlines()[0]
        if not df.columns:
            return "the file has no column"
        drops = [c for c in drop_columns.get(name, ()) if c in df.columns]
        return df.drop(*drops) if drops else df

    # Schema inference runs small jobs per file; submitting them from a few
    # driver threads lets Spark run them side by side. Order stays by name.
    with ThreadPoolExecutor(max_workers=min(8, len(entries))) as pool:
        # Jobs from the pool keep the caller's job group, description and pool.
        loaded = list(pool.map(inheritable_thread_target(spark)(load), entries))
    tables: dict[str, DataFrame] = {}
    for (name, path), result in zip(entries, loaded):
        if isinstance(result, DataFrame):
            tables[name] = result
            continue
        warnings.warn(f"{path} left out: {result}", stacklevel=2)
        if skipped is not None:
            skipped.append((name, result))
    if not tables:
        raise ValueError(f"none of the CSV files in {directory} could be loaded")
    return tables

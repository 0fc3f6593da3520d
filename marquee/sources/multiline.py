"""Multi-line CSV (quoted fields may hold line breaks) read by many tasks.

A line break ends a record exactly when the quotes before it, in the whole file,
are even in number: a doubled quote inside a quoted field adds two. So the reader
does not have to parse a file from its start; it needs the parity of the quotes
in front of each split. This is a prefix scan in two passes:

1. Lines are read splittably and their quotes counted. Each split leaves one row
   (its parity, by partial aggregation), and parities are summed along each file:
   that is the state in which the split begins.
2. Lines are dealt out by split and put in order; running parities inside a split
   say which lines start a record. Lines of a record are joined again. A record
   that runs over a split's end is put together from the splits' border pieces, at
   most two rows a split; all other records never leave their task.

Every record is then parsed by Spark's own CSV expression with the profile's
options, so types, null sentinels, malformed cells and pruning of columns follow
the plain reader.

This needs well-formed quoting (RFC 4180): a quote appears only around a field or
doubled inside one, and escaping is by doubling. A file with a lone quote inside an
unquoted field (``5" disk``) has to be read with ``splittable=False`` of
``read_delimited``; a quote that is never closed makes one record of the rest of
the file, as for any reader. Line breaks inside a field are kept as written; those
that end a record, and empty lines between records, are not part of it. Compressed
files cannot be split by Spark and are then one split. The rows come in no
particular order; ``PLACE`` gives the files' order.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Place of a record in its input, in order: file, split, number of the record in the split.
PLACE = ("_file", "_split", "_record")


def _lines(spark: SparkSession, paths: list[str], encoding: str, quote: str) -> DataFrame:
    """Every line with its file, split, running id and quote parity; lines keep a closing ``\\r``."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return (spark.read.option("lineSep", "\n").option("encoding", encoding).text(paths)
            .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                    F.monotonically_increasing_id().alias("_line"), "value", (quotes % 2).alias("_odd")))


def _opening_parity(lines: DataFrame) -> DataFrame:
    """Per split, whether it begins inside a quoted field (1) or not (0)."""
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    sums = lines.groupBy("_file", "_split").agg(F.sum("_odd").alias("_odd"))
    return sums.select("_file", "_split", (F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2).alias("_opens"))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _joined(lines: Column) -> Column:
    """The lines of a record, in order, as written."""
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["value"]), "\n")


def record_texts(spark: SparkSession, path: str | Iterable[str], quote: str = '"',
                 encoding: str = "UTF-8") -> DataFrame:
    """``_file, _split, _record, text``: every record of the files as written, and its place.

    ``_record`` counts from 1 in the split that the record starts in; 0 holds
    the empty lines before the first record of a file, if there are any.
    """
    lines = _lines(spark, [path] if isinstance(path, str) else list(path), encoding, quote)
    in_split = Window.partitionBy("_file", "_split").orderBy("_line")
    whole_split = Window.partitionBy("_file", "_split")
    odd_before = F.coalesce(F.sum("_odd").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opens = _opening_parity(lines).select(F.col("_file").alias("_f"), F.col("_split").alias("_s"), "_opens")
    # Running numbers first: the exchange by split then serves the grouping into records too.
    running = lines.withColumn("_before", odd_before)
    placed = (running.join(opens, (F.col("_file") == F.col("_f")) & (F.col("_split") == F.col("_s")))
              # Empty lines between records stay with the record before them.
              .withColumn("_starts", (((F.col("_before") + F.col("_opens")) % 2 == 0)
                                      & ~F.col("value").isin("", "\r")).cast("int"))
              .withColumn("_record", F.sum("_starts").over(in_split)))
    pieces = (placed.groupBy("_file", "_split", "_record")
              .agg(F.collect_list(F.struct("_line", "value")).alias("_lines"))
              .select("_file", "_split", "_record", _joined(F.col("_lines")).alias("text"))
              .withColumn("_last", F.max("_record").over(whole_split)))
    # Record 0 is the rest of a record that an earlier split began; the last one may go on in the next split.
    border = (F.col("_record") == 0) | (F.col("_record") == F.col("_last"))
    along = Window.partitionBy("_file").orderBy("_split", "_record")
    parts = (pieces.where(border)
             .withColumn("_whole", F.sum((F.col("_record") > 0).cast("int")).over(along)))
    merged = (parts.groupBy("_file", "_whole")
              .agg(F.array_sort(F.collect_list(F.struct("_split", "_record", "text"))).alias("_parts"))
              .select("_file", F.col("_parts")[0]["_split"].alias("_split"),
                      F.col("_parts")[0]["_record"].alias("_record"),
                      F.array_join(F.transform("_parts", lambda x: x["text"]), "\n").alias("text")))
    return pieces.where(~border).select(*PLACE, "text").unionByName(merged)


def read_multiline(spark: SparkSession, path: str | Iterable[str], schema: StructType, options: dict[str, str],
                   with_place: bool = False) -> DataFrame:
    """The files as a table of ``schema``; ``with_place`` adds the columns ``PLACE`` that order its rows.

    ``options`` are those of Spark's CSV reader; quote and escape must be one
    character.
    """
    quote = options.get("quote", '"')
    if not quote or options.get("escape") != quote:
        raise ValueError("records can be told apart by their quotes only if quotes are escaped by doubling")
    records = record_texts(spark, path, quote, options.get("encoding", "UTF-8"))
    if options.get("header") == "true":  # the first record of each file
        records = records.where((F.col("_split") > 0) | (F.col("_record") > 1))
    text = F.regexp_replace("text", "[\\r\\n]+\\z", "")
    used = {k: v for k, v in options.items() if k not in ("header", "encoding")}
    parsed = (records.withColumn("text", text).where("text <> ''")
              .select(*PLACE, F.from_csv("text", _ddl(schema), used).alias("_row")))
    return parsed.select(*(PLACE if with_place else ()), "_row.*")

"""Delimited text (CSV / TSV / pipe) readers and writers driven by named profiles.

A profile bundles the options that decide how a file is split into fields:
separator, quoting, escaping, multi-line records, null sentinel and encoding.
Reading with an explicit schema costs no job; ``infer=True`` costs two eager
passes over the input, so keep it for exploration.

Malformed cells under an explicit schema become NULL (Spark's PERMISSIVE
mode); downstream filters decide what to keep.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from marquee.sources.multiline import read_multiline


@dataclass(frozen=True)
class Profile:
    """How a delimited file is laid out. ``options`` are passed to Spark as-is."""

    name: str
    sep: str = ","
    header: bool = True
    quote: str | None = '"'
    escape: str | None = None
    multi_line: bool = False
    null_value: str | None = None
    encoding: str = "UTF-8"
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {
            "sep": self.sep,
            "header": str(self.header).lower(),
            "encoding": self.encoding,
            "multiLine": str(self.multi_line).lower(),
            # Keep field text exactly as written, in both directions.
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }
        # quote "" switches quoting off: a leading '"' is then plain text and
        # cannot swallow the separator that follows it.
        if self.quote is not None:
            opts["quote"] = self.quote
        if self.escape is not None:
            opts["escape"] = self.escape
        if self.null_value is not None:
            opts["nullValue"] = self.null_value
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts

    def with_(self, **changes) -> "Profile":
        return replace(self, **changes)


# Fixed layouts of the inputs the reports are written for.
# RFC-4180 CSV: comma, header, '"' quotes doubled inside fields, fields may
# span lines.
RFC4180_CSV = Profile("rfc4180_csv", sep=",", header=True, quote='"', escape='"',
                      multi_line=True)
# Plain comma CSV with header, quotes honoured, one record per line.
PLAIN_CSV = Profile("plain_csv", sep=",", header=True, quote='"', escape='"')
# IMDb-style TSV: tab, header, no quoting, "\N" marks a missing value.
IMDB_TSV = Profile("imdb_tsv", sep="\t", header=True, quote="", null_value="\\N")
# Same files without their header line; column names are assigned by position.
IMDB_TSV_HEADERLESS = IMDB_TSV.with_(name="imdb_tsv_headerless", header=False)
# Pipe-delimited result files: header, UTF-8, '"' quote and escape.
PIPE_CSV = Profile("pipe_csv", sep="|", header=True, quote='"', escape='"')


def read_delimited(spark: SparkSession, path: str | Iterable[str], profile: Profile,
                   schema: StructType | str | None = None,
                   names: Iterable[str] | None = None,
                   infer: bool = False, splittable: bool = True) -> DataFrame:
    """Read delimited text.

    schema  explicit schema, bound to fields by position (header names are
            not checked); preferred: no inference job, typed from the start.
    names   rename all columns by position after reading (headerless files).
    infer   let Spark infer types (two eager passes over the data).
    splittable  with a schema, multi-line files whose quotes are escaped by
            doubling are read by many tasks (see ``multiline``; rows then come
            in no particular order). False: one task a file, rows in file order.
    """
    if splittable and schema is not None and _splits(profile):
        typed = _parse_datatype_string(schema) if isinstance(schema, str) else schema
        df = read_multiline(spark, path, typed, profile.options())
        return df if names is None else df.toDF(*names)
    reader = spark.read.options(**profile.options())
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.csv(paths)
    if names is not None:
        df = df.toDF(*names)
    return df


def _splits(profile: Profile) -> bool:
    """Can records be told apart by counting quotes, and parsed one by one?"""
    return (profile.multi_line and bool(profile.quote) and profile.escape == profile.quote
            and str(profile.extra.get("mode", "PERMISSIVE")).upper() != "DROPMALFORMED"
            and "lineSep" not in profile.extra and "comment" not in profile.extra)


def read_by_header(spark: SparkSession, path: str, profile: Profile,
                   schema: StructType, splittable: bool = True) -> DataFrame:
    """Read a headed file whose column order is unknown, typing columns by name.

    The header is read first (a one-line job), then the file is read with the
    declared types placed in the header's order, so types bind to the right
    names whatever order the producer wrote them in. Columns absent from
    ``schema`` are read as strings.
    """
    header_cols = read_delimited(spark, path, profile).columns
    by_name = {f.name: f for f in schema.fields}
    ordered = StructType([by_name.get(c, StructField(c, StringType(), True)) for c in header_cols])
    return read_delimited(spark, path, profile, schema=ordered, splittable=splittable)


def write_delimited(df: DataFrame, path: str, profile: Profile, mode: str = "errorifexists") -> None:
    """Write ``df`` as a directory of delimited part files.

    mode  ``errorifexists`` (default: a second run fails instead of silently
          replacing results), ``overwrite``, ``append`` or ``ignore``.
    """
    opts = profile.options()
    opts.pop("multiLine", None)  # reader-only option
    df.write.mode(mode).options(**opts).csv(path)

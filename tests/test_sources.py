"""Delimited readers/writers, directory ingest."""

import os

import pytest

from conftest import FIXTURES, rows
from marquee.session import scratch_path
from marquee.sources import (IMDB_TSV, PIPE_CSV, PLAIN_CSV, RFC4180_CSV, read_by_header,
                             read_delimited, read_directory, write_delimited)

TRICKY = [(1, "a|b", 'q"x'), (2, "  padded  ", "comma, inside"), (3, "multi\nline", "")]


@pytest.mark.parametrize("profile", [PIPE_CSV, RFC4180_CSV])
def test_round_trip_keeps_text(spark, profile):
    df = spark.createDataFrame(TRICKY, "id int, a string, b string")
    path = scratch_path(spark, "rt")
    write_delimited(df.coalesce(1), path, profile)
    back = read_delimited(spark, path, profile.with_(multi_line=True), schema=df.schema)
    # Identity, except that Spark's CSV reader returns an empty string as NULL.
    expected = [tuple(None if v == "" else v for v in r) for r in TRICKY]
    assert sorted(rows(back), key=repr) == sorted(expected, key=repr)


def test_default_mode_refuses_to_overwrite(spark):
    df = spark.range(2)
    path = scratch_path(spark, "once")
    write_delimited(df, path, PLAIN_CSV)
    with pytest.raises(Exception):
        write_delimited(df, path, PLAIN_CSV)
    write_delimited(df, path, PLAIN_CSV, mode="overwrite")


def test_tsv_sentinel_round_trip(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, s string")
    path = scratch_path(spark, "tsv")
    write_delimited(df, path, IMDB_TSV)
    raw = spark.read.text(path).collect()
    assert any("\\N" in r[0] for r in raw)
    assert sorted(rows(read_delimited(spark, path, IMDB_TSV, schema=df.schema))) == [(1, None), (2, "x")]


def test_read_by_header_binds_types_by_name(spark):
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                         StructField("rating", DoubleType())])
    df = read_by_header(spark, os.path.join(FIXTURES, "letterboxd", "movies.csv"), RFC4180_CSV, schema)
    types = dict(df.dtypes)
    assert types["id"] == "int" and types["rating"] == "double" and types["date"] == "string"


def test_directory_ingest_drops_listed_columns_and_skips_other_files(spark):
    tables = read_directory(spark, os.path.join(FIXTURES, "concat_dir"), RFC4180_CSV)
    assert list(tables) == ["actors", "genres", "movies"]
    assert tables["movies"].columns == ["id", "name", "date", "rating"]
    assert tables["actors"].count() == 4


def test_directory_ingest_errors_without_csv(spark, tmp_path):
    (tmp_path / "only.txt").write_text("x\n")
    with pytest.raises(ValueError):
        read_directory(spark, str(tmp_path))


def test_directory_ingest_excludes_named_output(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    (tmp_path / "combined_all_data.csv").write_text("k\n2\n")
    tables = read_directory(spark, str(tmp_path), exclude=("combined_all_data",))
    assert list(tables) == ["a"]


def test_write_then_preview_reads_the_written_output(spark):
    from pyspark.sql import functions as F
    from marquee.sources import write_then_preview
    df = spark.range(100).select((F.col("id") * 3).alias("v"), (F.col("id") % 7).alias("k"))
    path = scratch_path(spark, "preview")
    top = write_then_preview(df, path, PLAIN_CSV, 5, order_by=[F.col("v").desc()])
    assert [r[0] for r in top.collect()] == [297, 294, 291, 288, 285]
    assert spark.read.options(header="true").csv(path).count() == 100


def test_scratch_paths_live_under_the_session_checkpoint_folder(spark):
    base = spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(base.rstrip("/")) or a.startswith(base.split(":", 1)[-1].rstrip("/"))


def test_directory_ingest_accepts_a_relative_path(spark):
    rel = os.path.relpath(os.path.join(FIXTURES, "concat_dir"))
    assert not os.path.isabs(rel)
    assert list(read_directory(spark, rel, RFC4180_CSV)) == ["actors", "genres", "movies"]
    assert list(read_directory(spark, rel + "/", RFC4180_CSV)) == ["actors", "genres", "movies"]


def test_directory_names_what_it_leaves_out_and_raises_everything_else(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    skipped = []
    with pytest.warns(UserWarning, match="empty.csv left out"):
        tables = read_directory(spark, str(tmp_path), skipped=skipped)
    assert list(tables) == ["a"] and [name for name, _ in skipped] == ["empty"] and skipped[0][1]

    from marquee.sources import directory

    def lost(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(directory, "read_delimited", lost)
    with pytest.raises(RuntimeError, match="executor lost"):
        read_directory(spark, str(tmp_path))


def test_declared_schemas_spare_the_inference_job(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    (tmp_path / "a.csv").write_text("y,x\nb,1\n")
    schema = StructType([StructField("x", LongType()), StructField("y", StringType())])
    table = read_directory(spark, str(tmp_path), schemas={"a": schema})["a"]
    assert dict(table.dtypes) == {"y": "string", "x": "bigint"} and rows(table) == [("b", 1)]


def test_listing_gives_one_entry_a_folder_of_part_files(spark, tmp_path):
    from marquee.sources.directory import list_entries
    folder = tmp_path / "big.csv"
    folder.mkdir()
    for i in range(30):
        (folder / f"part-{i:05}.csv").write_text("x\n1\n")
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "_hidden.csv").write_text("x\n1\n")
    assert [name for name, _ in list_entries(spark, str(tmp_path))] == ["a", "big"]

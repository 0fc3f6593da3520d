"""Multi-line CSV read by many tasks: same rows as Spark's one-task reader, whatever the split borders cut."""

import csv
import random

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from marquee.sources import PIPE_CSV, RFC4180_CSV, read_by_header, read_delimited
from marquee.sources.multiline import read_multiline, record_texts

SCHEMA = StructType([StructField("id", IntegerType()), StructField("some text", StringType()),
                     StructField("v", DoubleType())])
PARTS = ["a", '"', ",", "\n", "\n\n", "\r\n", "é漢", "x y", "''", '""', ",\n", " "]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10",
            "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, rows, line_end="\n", delimiter=","):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=line_end, delimiter=delimiter)
        w.writerow(SCHEMA.names)
        w.writerows(rows)


def random_rows(seed, n):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 30 if i % 40 else 1500))), i * 1.5)
            for i in range(n)]


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, line_end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_records_across_split_borders(spark, small_splits, tmp_path, seed, line_end):
    path = str(tmp_path / "x.csv")
    rows = random_rows(seed, 150)
    write(path, rows, line_end)
    got = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA)
    one_task = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA, splittable=False)
    assert tuples(got) == sorted(rows)
    if line_end == "\n":  # Spark's own reader writes \n for the \r\n inside fields of such files
        assert tuples(got) == tuples(one_task)
    placed = read_multiline(spark, path, SCHEMA, RFC4180_CSV.options(), with_place=True)
    in_order = placed.orderBy("_file", "_split", "_record").collect()
    assert [r["id"] for r in in_order] == list(range(150))
    assert len({r["_split"] for r in in_order}) > 5


def test_one_record_over_many_splits_and_no_record_in_some(spark, small_splits, tmp_path):
    path = str(tmp_path / "x.csv")
    rows = [(1, "short", 1.0), (2, 'line "quoted",\n' * 900, 2.0), (3, "after\nit", 3.0)]
    write(path, rows)
    assert tuples(read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA)) == rows


def test_files_of_a_folder_each_with_header_blank_lines_and_no_last_line_end(spark, small_splits, tmp_path):
    for k in range(3):
        write(str(tmp_path / f"{k}.csv"), random_rows(10 + k, 40))
    (tmp_path / "3.csv").write_text('\n\r\nid,some text,v\n\n7,"a\n\nb",1.0\r\n\n\n8,plain,2.0', newline="")
    got = read_delimited(spark, str(tmp_path), RFC4180_CSV, schema=SCHEMA)
    want = [r for k in range(3) for r in random_rows(10 + k, 40)] + [(7, "a\n\nb", 1.0), (8, "plain", 2.0)]
    assert tuples(got) == sorted(want)


def test_malformed_cells_short_rows_and_empty_files_follow_the_plain_reader(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,some text,v\nx,"t\nu",1.0\n1\n2,b,3.5,extra\n,,\n"3","q""q",-1\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("id,some text,v\n")
    for name in ("a", "b", "c"):
        path = str(tmp_path / f"{name}.csv")
        got = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA).collect()
        want = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA, splittable=False).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_other_separator_by_header_and_without_header(spark, small_splits, tmp_path):
    path, rows = str(tmp_path / "x.csv"), random_rows(5, 60)
    write(path, rows, delimiter="|")
    pipes = PIPE_CSV.with_(multi_line=True)
    reordered = StructType([SCHEMA["v"], SCHEMA["some text"], SCHEMA["id"]])
    assert tuples(read_by_header(spark, path, pipes, reordered)) == sorted(rows)
    (tmp_path / "bare.csv").write_text('1,"a\nb",2\n2,c,3\n')
    bare = read_delimited(spark, str(tmp_path / "bare.csv"), RFC4180_CSV.with_(header=False), schema=SCHEMA,
                          names=["p", "q", "r"])
    assert bare.columns == ["p", "q", "r"] and tuples(bare) == [(1, "a\nb", 2.0), (2, "c", 3.0)]


def test_only_used_columns_are_parsed_and_lines_are_dealt_out_once(spark, small_splits, tmp_path):
    path = str(tmp_path / "x.csv")
    write(path, random_rows(6, 50))
    df = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA).select("v")
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "SinglePartition" not in text
    assert "ReusedExchange" in text  # the border pieces read the lines' one exchange


def test_quotes_not_escaped_by_doubling_are_left_to_the_plain_reader(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    (tmp_path / "x.csv").write_text('id,some text,v\n1,"a\\"b\nc",2.0\n')
    profile = RFC4180_CSV.with_(escape="\\")
    assert tuples(read_delimited(spark, path, profile, schema=SCHEMA)) == [(1, 'a"b\nc', 2.0)]
    with pytest.raises(ValueError, match="doubling"):
        read_multiline(spark, path, SCHEMA, profile.options())
    (tmp_path / "x.csv").write_text('id,some text,v\n1,5" disk,2.0\n2,"a\nb",3.0\n')
    lone = read_delimited(spark, path, RFC4180_CSV, schema=SCHEMA, splittable=False)
    assert tuples(lone) == [(1, '5" disk', 2.0), (2, "a\nb", 3.0)]


def test_record_texts_hold_every_character(spark, small_splits, tmp_path):
    path = str(tmp_path / "x.csv")
    write(path, random_rows(8, 80))
    texts = [r.text for r in record_texts(spark, path).orderBy("_split", "_record").collect()]
    with open(path, newline="", encoding="utf-8") as f:
        assert "\n".join(texts) + "\n" == f.read()

"""Operator semantics and invariants."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from marquee.functions import split_packed, to_int
from marquee.operators import (bucket_avg, concat_columns, first_wins, positional_index, rank_within,
                               table_profile, top_n_per_group, two_source_counts)


def _random_scores(spark, seed, n=400, groups=6, values=5):
    rnd = random.Random(seed)
    data = [(rnd.choice([None] + [f"g{i}" for i in range(groups)]),
             rnd.choice([None] + list(range(values))), i) for i in range(n)]
    return spark.createDataFrame(data, "grp string, score int, id int")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_equal_the_textbook_window(spark, seed, descending):
    df = _random_scores(spark, seed)
    order = F.col("score").desc_nulls_last() if descending else F.col("score").asc_nulls_first()
    want = sorted(rows(df.select("id", F.rank().over(Window.partitionBy("grp").orderBy(order)))))
    assert sorted(rows(rank_within(df, "grp", "score", descending).select("id", "rank"))) == want
    top = top_n_per_group(df, "grp", "score", 3, descending=descending)
    assert sorted(rows(top.select("id", "rank"))) == [w for w in want if w[1] <= 3]


def test_top_n_keeps_every_tie_of_a_hot_group(spark):
    # One group holds most rows and they all share the top value.
    data = [("hot", 9, i) for i in range(300)] + [("hot", 5, 1000), ("cold", 1, 2000)]
    df = spark.createDataFrame(data, "grp string, score int, id int")
    out = top_n_per_group(df, "grp", "score", 2)
    got = rows(out.groupBy("grp", "rank").count().orderBy("grp", "rank"))
    assert got == [("cold", 1, 1), ("hot", 1, 300)]


def test_two_source_counts_full_outer_union_and_zero_fill(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(2,), (3,), (3,), (3,)], "k int")
    assert rows(two_source_counts(left, right, "k", "l", "r")) == [(3, 0, 3), (2, 1, 1), (1, 2, 0)]


def test_bucket_floor_vs_trunc_below_zero(spark):
    df = spark.createDataFrame([(-5, 1.0), (-15, 3.0), (7, 2.0)], "y int, v double")
    assert rows(bucket_avg(df, "y", "v", 10, "floor", "b", "m")) == [(-20, 3.0), (-10, 1.0), (0, 2.0)]
    assert rows(bucket_avg(df, "y", "v", 10, "trunc", "b", "m")) == [(-10, 3.0), (0, 1.5)]


def test_rounding_goes_half_up_once(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.1 + 0.2,), (3.0149999996,)], "x double")
    assert [r[0] for r in df.select(F.round("x", 2)).collect()] == [1.01, 2.68, 0.3, 3.01]
    from marquee.operators import sql_forms
    text = sql_forms.score_by_label_sql("{t}", "g", "i", "{l}", "k", "n", "r", "w", "label", "c", "a", "t", "s", digits=2)
    assert text.count("ROUND(") == 2 and "ROUND(ROUND" not in text
    one = spark.createDataFrame([("g", 1, 3.0149999996, 1)], "g string, i int, r double, w int")
    names = spark.createDataFrame([(1, "x")], "k int, n string")
    got = spark.sql(text, t=one, l=names).first()
    assert (got["a"], got["s"]) == (3.01, 3.01)


def test_split_packed_is_literal_and_keeps_empty_parts(spark):
    df = spark.createDataFrame([("a|b||c",), ("x.y",)], "s string")
    assert [r[0] for r in df.select(split_packed("s", "|")).collect()][0] == ["a", "b", "", "c"]
    assert [r[0] for r in df.select(split_packed("s", ".")).collect()][1] == ["x", "y"]


def test_to_int_is_ansi_safe(spark):
    df = spark.createDataFrame([("1999",), ("\\N",), ("1999.0",), ("abc",), (None,)], "s string")
    assert [r[0] for r in df.select(to_int("s")).collect()] == [1999, None, None, None, None]


def test_positional_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    out = rows(positional_index(df, ["k"], "pos").orderBy("pos"))
    assert [p for _, p in out] == list(range(1000))
    assert [k for k, _ in out] == sorted(k for k, _ in out)


def test_concat_columns_pads_and_first_wins(spark):
    a = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id int, x string")
    b = spark.createDataFrame([(20, "B"), (10, "A")], "id int, y string")
    out = concat_columns([a, b], [["id"], ["id"]])
    assert out.columns == ["id", "x", "y"]
    assert rows(out) == [(1, "a", "A"), (2, "b", "B"), (3, "c", None)]
    assert first_wins([["id", "x"], ["id", "y"]]) == [["id", "x"], ["y"]]


def test_table_profile(spark):
    t = {"one": spark.range(3), "two": spark.createDataFrame([(1, "a")], "a int, b string")}
    assert sorted(rows(table_profile(t))) == [("one", 3, 1, "id"), ("two", 1, 2, "a,b")]


def test_score_by_label_equals_grouping_by_the_label(spark):
    from marquee.operators import score_by_group, score_by_label
    rows_ = [("g1", 1, 8.0, 10), ("g1", 1, 6.0, 5), ("g1", 2, 7.0, 1), ("g2", 3, None, 4),
             ("g2", 1, 9.0, None), ("g1", 9, 5.0, 5)]
    df = spark.createDataFrame(rows_, "grp string, pid int, rating double, votes int")
    # Ids 1 and 2 share a name; id 9 has no name and drops out (inner join).
    names = spark.createDataFrame([(1, "Ann"), (2, "Ann"), (3, "Bob")], "pid int, name string")
    direct = score_by_group(df.join(names, "pid"), ["grp", "name"], "rating", "votes")
    late = score_by_label(df, "grp", "pid", names, "pid", "name", "rating", "votes")
    assert sorted(rows(late.select(*direct.columns))) == sorted(rows(direct))


def _hot_key_tables(spark):
    rnd = random.Random(7)
    parents = [(k, None if k % 11 == 3 else float(k * 10)) for k in range(50)]
    # Key 5 holds about two thirds of the child rows.
    children = [(5 if rnd.random() < 0.66 else rnd.randrange(60), rnd.choice("ABC"),
                 rnd.choice([None, 1.5, 2.5, 4.0])) for _ in range(3000)]
    p = spark.createDataFrame(parents, "k int, price double")
    c = spark.createDataFrame(children, "ck int, flag string, amount double")
    return p, c


def test_avg_by_key_with_a_hot_key_equals_direct_mean(spark):
    from marquee.operators import avg_by_key
    p, c = _hot_key_tables(spark)
    got = rows(avg_by_key(p, c, [("k", "ck")], "flag", "price", "m"))
    direct = rows(p.join(c, p["k"] == c["ck"]).groupBy("flag").agg(F.avg("price").alias("m"))
                  .orderBy("flag"))
    assert [g for g, _ in got] == [g for g, _ in direct]
    assert [m for _, m in got] == [pytest.approx(m) for _, m in direct]


def test_avg_by_packed_key_with_a_hot_key_equals_direct_mean(spark):
    from marquee.operators import avg_by_packed_key
    p, c = _hot_key_tables(spark)
    names = p.select(F.col("k").alias("key"),
                     F.concat_ws(",", F.lit("x"), (F.col("k") % 3).cast("string")).alias("tags"))
    facts = c.select(F.col("ck").alias("key"), "amount")
    got = rows(avg_by_packed_key(names, facts, "key", "tags", "amount", exclude=["1"], group="t"))
    exploded = names.join(facts, "key").select(F.explode(F.split("tags", ",")).alias("t"), "amount")
    direct = rows(exploded.groupBy("t").agg(F.avg("amount")).filter("t <> '1'").orderBy("t"))
    assert [t for t, _ in got] == [t for t, _ in direct]
    assert [m for _, m in got] == [pytest.approx(m) for _, m in direct]


def test_counts_add_up_to_the_input_rows(spark):
    from marquee.operators import count_by_key
    _, c = _hot_key_tables(spark)
    counts = count_by_key(c, "flag", "n")
    assert counts.agg(F.sum("n")).first()[0] == c.count()


def test_positional_index_splits_a_key_shared_by_many_rows(spark):
    # 3,000 identical keys among 3,100 rows: the sort must still spread them.
    df = spark.createDataFrame([(1, i) for i in range(3000)] + [(2, i) for i in range(100)],
                               "k int, payload int").repartition(8)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep the sort's partitions as planned
    try:
        out = positional_index(df, ["k"], "pos")
        parts = rows(out.groupBy(F.spark_partition_id().alias("p")).count())
    finally:
        spark.conf.set(key, before)
    assert sorted(p for (p,) in rows(out.select("pos"))) == list(range(3100))
    assert max(c for _, c in parts) < 3000


def test_avg_by_key_keeps_double_precision_for_float_values(spark):
    from marquee.operators import avg_by_key
    parent = spark.createDataFrame([(1, 4.1), (2, 3.3)], "k int, v float")
    child = spark.createDataFrame([(1, "a")] * 7 + [(2, "a")] * 3, "k int, g string")
    got = rows(avg_by_key(parent, child, "k", "g", "v", "m"))
    direct = rows(parent.join(child, "k").groupBy("g").agg(F.avg("v").alias("m")))
    assert got[0][1] == pytest.approx(direct[0][1], rel=1e-15)


def test_buckets_never_fail_on_extreme_values(spark):
    df = spark.createDataFrame([(3e9, 1.0), (-5.0, 2.0), (1e300, 3.0)], "y double, v double")
    floor = dict(rows(bucket_avg(df, "y", "v", 10, "floor", "b", "m")))
    trunc = dict(rows(bucket_avg(df, "y", "v", 10, "trunc", "b", "m")))
    assert floor == {None: 2.0, -10: 2.0} and trunc == {None: 2.0, 0: 2.0}


def test_cleaning_helpers(spark):
    from marquee.operators import (cast_columns, drop_present, keep_matching, nullify_sentinels,
                                   rename_columns)
    df = spark.createDataFrame([("1999", "\\N", "x"), ("19x9", "7", "y"), ("\\N", "8", "z")],
                               "year string, n string, tag string")
    cleaned = cast_columns(nullify_sentinels(df, ["year", "n"]), {"year": "int", "n": "int"})
    assert rows(cleaned) == [(1999, None, "x"), (None, 7, "y"), (None, 8, "z")]
    assert rows(keep_matching(df, "year", "^[0-9]{4}$").select("tag")) == [("x",)]
    renamed = rename_columns(drop_present(df, ["n", "missing"]), {"tag": "label"})
    assert renamed.columns == ["year", "label"]


def test_concurrent_jobs_keep_the_callers_job_group(spark):
    sc = spark.sparkContext
    a = spark.createDataFrame([(2,), (1,)], "x int")
    b = spark.createDataFrame([(5,), (4,), (3,)], "y int")
    sc.setJobGroup("marquee-pool-test", "positional indexes from pool threads")
    try:
        concat_columns([a, b], [["x"], ["y"]])  # builds: index jobs run in pool threads only
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("marquee-pool-test")) >= 2

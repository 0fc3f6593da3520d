"""Operators that split hot groups and keys by themselves: same results, no group in one task."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import concat_columns, heavy_buckets, positional_index, prefix_counts, rank_within, split_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("descending", [True, False])
def test_rank_of_one_group_with_all_rows_uses_many_bins(spark, no_broadcast, descending):
    rng = random.Random(4)
    rows = [(1, rng.random()) for _ in range(4000)] + [(None, rng.choice([1.0, None, 2.0])) for _ in range(50)] \
        + [(2, 5.0)] * 30 + [(3, None)]
    df = spark.createDataFrame(rows, "g INT, v DOUBLE")
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(order)))
    assert tuples(rank_within(df, "g", "v", descending, bins=9)) == tuples(want)
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # one task a partition
    try:
        placed = prefix_counts(counts, "g", "v", descending, "n", "better", bins=9)
        sizes = [len(p) for p in placed.where("g = 1").rdd.glom().collect() if p]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 3 and max(sizes) < 2500


def test_rank_of_text_and_of_an_empty_table(spark):
    rng = random.Random(5)
    rows = [("x", "shared prefix " + "".join(rng.choice("abc") for _ in range(4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "g STRING, v STRING")
    want = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())))
    assert tuples(rank_within(df, "g", "v")) == tuples(want)
    assert rank_within(df.limit(0), "g", "v").count() == 0


def test_positions_of_files_need_no_sort(spark, tmp_path):
    paths = []
    for name, n in (("a", 900), ("b", 400)):
        paths.append(str(tmp_path / name))
        (spark.range(n).select(F.col("id").alias(name), F.concat(F.lit("row "), 5000 - F.col("id")).alias(f"{name}_text"))
         .coalesce(1).write.csv(paths[-1], header=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        a, b = (spark.read.csv(p, header=True, schema=f"{n} LONG, {n}_text STRING") for p, n in zip(paths, "ab"))
        indexed = positional_index(a)
        assert "rangepartitioning" not in plan(indexed) and indexed.rdd.getNumPartitions() > 3
        assert sorted((r["_position"], r["a"]) for r in indexed.collect()) == [(i, i) for i in range(900)]
        rows = concat_columns([a, b]).collect()
        assert [(r["a"], r["b"]) for r in rows] == [(i, i if i < 400 else None) for i in range(900)]
        # Filters and projections stay a plain read; a join does not, and keeps its partitions' order.
        part = positional_index(a.where("a % 3 = 0").select("a"))
        assert sorted((r["_position"], r["a"]) for r in part.collect()) == [(i, 3 * i) for i in range(300)]
        joined = positional_index(a.join(b, a["a"] == b["b"]))
        assert sorted(r["_position"] for r in joined.collect()) == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def hot_tables(spark):
    rng = random.Random(6)
    facts = [(7 if rng.random() < .4 else rng.choice([*range(100), None]), i) for i in range(5000)]
    names = [(k, f"n{k}") for k in range(0, 120, 2)] + [(7, "seven"), (7, "again"), (None, "none")]
    return spark.createDataFrame(facts, "k INT, v LONG"), spark.createDataFrame(names, "key LONG, name STRING")


def test_split_join_equals_the_plain_join(spark, no_broadcast):
    facts, names = hot_tables(spark)
    want = tuples(facts.join(names, facts["k"] == names["key"]))
    for shares, buckets in ((8, 1 << 14), (64, 1 << 14), (16, 1), (16, 3)):
        joined = split_join(facts, names, [("k", "key")], shares, buckets)
        assert joined.columns == ["k", "v", "key", "name"] and tuples(joined) == want
    spread = split_join(facts, names, [("k", "key")], 16, spread=F.xxhash64("v"))
    assert tuples(spread) == want
    assert split_join(facts.limit(0), names, [("k", "key")]).count() == 0
    with pytest.raises(ValueError, match="types"):
        split_join(facts.select(F.col("k").cast("string").alias("k")), names, [("k", "key")])


def test_split_join_on_a_composite_key(spark):
    facts, names = hot_tables(spark)
    facts, names = facts.withColumn("w", F.lit("x")), names.withColumn("u", F.lit("x"))
    want = tuples(facts.join(names, (facts["k"] == names["key"]) & (facts["w"] == names["u"])))
    assert tuples(split_join(facts, names, [("k", "key"), ("w", "u")], 16)) == want


def test_heavy_keys_are_found_and_dealt_out(spark, no_broadcast):
    facts, names = hot_tables(spark)
    found = heavy_buckets(facts, ["k"], 32).collect()
    assert len(found) == 1 and 10 <= found[0].pieces <= 14  # two fifths of 32 shares
    assert heavy_buckets(facts, ["k"], 2).count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest(df):
            return max(len(p) for p in df.rdd.glom().collect())

        few = names.where("name <> 'again'")
        plain = largest(facts.join(few, facts["k"] == few["key"]))
        assert plain > 1900 and largest(split_join(facts, few, [("k", "key")])) < plain / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_exact_means_do_not_depend_on_the_order_of_rows(spark):
    from marquee.operators import exact_mean, mean_states, sql_forms, stats_of_states

    rng = random.Random(8)
    values = [rng.choice([0.1, 1e15, -1e15, 4.3, 1 / 3, None]) for _ in range(3000)] + [float("nan"), float("inf")]
    plain, digits = set(), set()
    for seed in range(4):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(1, v) for v in values], "g INT, v DOUBLE").repartition(seed + 1)
        plain.add(df.where("not isnan(v) and v <> double('inf')").agg(F.avg("v")).first()[0])
        text = f"SELECT {sql_forms.exact_mean('v')} FROM {{df}}"
        digits |= {df.agg(exact_mean("v")).first()[0], spark.sql(text, df=df).first()[0],
                   stats_of_states(mean_states(df, ["g"], "v"), ["g"], "m", "n").first()["m"]}
    assert len(digits) == 1 and len(plain) > 1
    nothing = spark.createDataFrame([(None,), (float("nan"),)], "v DOUBLE")
    assert nothing.agg(exact_mean("v")).first()[0] is None


def test_film_influence_has_the_same_digits_in_any_partitioning(spark):
    from marquee.plans import movies, movies_sql

    rng = random.Random(9)
    n = 400
    films = spark.createDataFrame([(i, f"t{i}", "2001", None, None, 90, 4.5) for i in range(n)], movies.MOVIES_SCHEMA)
    genres = spark.createDataFrame([(i, "Drama") for i in range(n)], movies.GENRES_SCHEMA)
    basics = spark.createDataFrame([(f"tt{i}", "movie", f"t{i}", f"t{i}", 0, 2001, None, 90, "Drama") for i in range(n)],
                                   movies.BASICS_SCHEMA)
    ratings = spark.createDataFrame([(f"tt{i}", rng.randrange(10, 100) / 10, rng.randrange(1, 10**6)) for i in range(n)],
                                    movies.RATINGS_SCHEMA)
    principals = spark.createDataFrame([(f"tt{i}", 1, "nm1", "actor", None, None) for i in range(n)],
                                       movies.PRINCIPALS_SCHEMA)
    names = spark.createDataFrame([("nm1", "One", None, None, None, None)], movies.NAMES_SCHEMA)
    seen = set()
    for parts in (1, 3, 7):
        dealt = [t.repartition(parts) for t in (films, genres, basics, ratings, principals, names)]
        keys = ("movies", "genres", "basics", "ratings", "principals", "names")
        seen.add((tuple(movies.actor_influence(*dealt).first()),
                  tuple(movies_sql.actor_influence_sql(spark, dict(zip(keys, dealt))).first())))
    assert len(seen) == 1


def test_trend_packs_read_their_rows_twice(spark):
    from conftest import SMALL_SF
    from marquee.plans import catalog

    for query in (catalog.trend_pack_df, catalog.trend_pack_sql):
        df = query(spark, SMALL_SF)
        df.collect()
        final = plan(df).split("Initial Plan")[0]
        assert final.count("Scan parquet") <= 2, final.count("Scan parquet")
        assert final.count("ReusedExchange") >= 2

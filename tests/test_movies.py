"""Golden results of the four film reports on hand-made inputs with planted traps."""

import os

import pytest

from conftest import FIXTURES, rows
from marquee.operators import concat_columns
from marquee.plans import movies as mv
from marquee.plans import movies_sql as mvs


@pytest.fixture(scope="module")
def lb(spark):
    return mv.load_letterboxd(spark, os.path.join(FIXTURES, "letterboxd"))


@pytest.fixture(scope="module")
def imdb(spark):
    return mv.load_imdb(spark, os.path.join(FIXTURES, "imdb"))


@pytest.fixture(scope="module")
def combined(spark):
    return mv.clean_combined(mv.load_combined(spark, os.path.join(FIXTURES, "combined_all_data.csv")))


def test_movies_bind_by_header_and_keep_multiline_text(lb):
    m = {r["id"]: r for r in lb["movies"].collect()}
    assert len(m) == 14
    assert m[2]["description"] == 'has, comma and "quotes" and\nnewline'
    assert m[2]["rating"] == 4.0 and m[2]["minute"] == 90 and m[2]["date"] == "2001"
    assert m[3]["date"] == "1999.0"
    assert m[4]["date"] is None and m[6]["minute"] is None and m[7]["rating"] is None


def test_imdb_sentinel_and_quote_handling(imdb):
    b = {r["tconst"]: r for r in imdb["basics"].collect()}
    assert b["tt3"]["primaryTitle"] is None          # \N is NULL
    assert b["tt4"]["primaryTitle"] == "N"           # a title literally "N" survives
    assert b["tt5"]["primaryTitle"] == '"Quoted Title'  # leading quote does not swallow tabs
    assert b["tt5"]["startYear"] == 2004
    assert b["tt6"]["startYear"] is None and b["tt6"]["genres"] is None


EXPECTED_P1 = [(2015, 1, 0), (2012, 1, 0), (2010, 1, 1), (2005, 1, 0), (2004, 0, 1),
               (2003, 0, 1), (2001, 1, 0), (1999, 1, 1), (1995, 1, 0), (1990, 1, 0)]


def test_high_rated_by_year(lb, imdb):
    out = mv.high_rated_by_year(lb["movies"], imdb["basics"], imdb["ratings"])
    assert out.columns == ["year", "count_letterboxd", "count_imdb"]
    assert rows(out) == EXPECTED_P1


def test_high_rated_by_year_sql(spark, lb, imdb):
    out = mvs.high_rated_by_year_sql(spark, lb["movies"], imdb["basics"], imdb["ratings"])
    assert rows(out) == EXPECTED_P1


def test_high_rated_by_year_all_years_full_outer_union(lb, imdb):
    out = rows(mv.high_rated_by_year(lb["movies"], imdb["basics"], imdb["ratings"], last=None))
    assert [r[0] for r in out] == [2015, 2012, 2010, 2005, 2004, 2003, 2001, 1999, 1995, 1990,
                                   1985, 1980]


def _approx_rows(out):
    return [(g, None if v is None else pytest.approx(v)) for g, v in out]


EXPECTED_P2A = [("Action", 4.6), ("Comedy", 12.4 / 3), ("Crime", 4.5), ("Drama", 27.1 / 6),
                ("Horror", 3.0), ("Mystery", None)]


def test_avg_rating_by_genre(spark, lb):
    df_out = rows(mv.avg_rating_by_genre(lb["movies"], lb["genres"]))
    sql_out = rows(mvs.avg_rating_by_genre_sql(spark, lb["movies"], lb["genres"]))
    assert df_out == _approx_rows(EXPECTED_P2A)
    assert sql_out == _approx_rows(EXPECTED_P2A)


EXPECTED_P2B = [("Action", 6.5), ("Comedy", 8.0), ("Crime", 8.0), ("Drama", 8.54)]


def test_avg_rating_by_packed_genre(spark, imdb):
    assert rows(mv.avg_rating_by_packed_genre(imdb["basics"], imdb["ratings"])) == _approx_rows(EXPECTED_P2B)
    assert rows(mvs.avg_rating_by_packed_genre_sql(spark, imdb["basics"], imdb["ratings"])) == \
        _approx_rows(EXPECTED_P2B)


def test_headerless_imdb_gives_same_report(spark):
    imdb = mv.load_imdb(spark, os.path.join(FIXTURES, "imdb_noheader"), header=False)
    assert rows(mv.avg_rating_by_packed_genre(imdb["basics"], imdb["ratings"])) == _approx_rows(EXPECTED_P2B)


def test_trend_reports(spark, combined):
    reports = mv.trend_reports(combined)
    yearly = rows(reports["yearly_genre_ratings"])
    assert yearly == [(-5, "Drama", 1.0, 1), (1985, "Horror", pytest.approx(3.3), 1),
                      (1999, "Comedy", 4.5, 2), (1999, "Drama", 4.5, 4),
                      (2000, "Drama", pytest.approx(10 / 3), 3), (2000, None, 3.0, 1),
                      (2000, "Comedy", 2.75, 2)]
    top = rows(reports["top_movies_per_year"])
    assert len(top) == 13
    assert [r for r in top if r[0] == 1999] == [(1999, f"A{i}", g, 4.5, 1) for i, g in
                                                zip(range(1, 7), ["Drama", "Comedy", "Drama",
                                                                  "Drama", "Comedy", "Drama"])]
    assert [(r[1], r[4]) for r in top if r[0] == 2000] == [("B1", 1), ("B2", 2), ("B3", 2),
                                                           ("B4", 4), ("B5", 5)]
    assert rows(reports["decade_avg_ratings"]) == [(0, 1.0), (1980, pytest.approx(3.3)),
                                                  (1990, 4.5), (2000, pytest.approx(18.5 / 6))]
    trends = rows(reports["genre_trends"])
    assert [t[0] for t in trends] == ["Drama", "Comedy"]
    assert trends[0][1:] == (pytest.approx(3.8), pytest.approx(10 / 3), pytest.approx(10 / 3 - 3.8))
    assert trends[1][1:] == (4.5, 2.75, -1.75)


def test_trend_reports_sql_agree_with_dataframe_forms(spark, combined):
    df_reports = mv.trend_reports(combined)
    sql_reports = mvs.trend_reports_sql(spark, combined)
    for key in ("yearly_genre_ratings", "top_movies_per_year", "genre_trends"):
        assert sorted(rows(df_reports[key]), key=repr) == sorted(rows(sql_reports[key + "_sql"]), key=repr)
    # Decades: the SQL form floors, the DataFrame form truncates; only year -5 differs.
    assert rows(sql_reports["decade_avg_ratings_sql"])[0] == (-10, 1.0)
    assert rows(df_reports["decade_avg_ratings"])[1:] == rows(sql_reports["decade_avg_ratings_sql"])[1:]


EXPECTED_P4 = [("Drama", "Ann Actor", 3, 25.1 / 3, 14200, 14200 * 25.1 / 3),
               ("Drama", "Eve Star", 1, 9.1, 10000, 91000.0),
               ("Crime", "Ann Actor", 2, 8.0, 4200, 33600.0),
               ("Crime", "Dan Director", 1, 8.0, 2100, 16800.0),
               ("Drama", "Dan Director", 1, 8.0, 2100, 16800.0),
               ("Action", "Eve Star", 2, 6.5, 300, 1950.0)]


def test_actor_influence(lb, imdb):
    out = mv.actor_influence(lb["movies"], lb["genres"], imdb["basics"], imdb["ratings"],
                             imdb["principals"], imdb["names"])
    assert out.columns == ["genre", "actor_name", "movie_count", "avg_rating", "total_votes",
                           "influence_score"]
    got = rows(out)
    assert [r[5] for r in got] == sorted([r[5] for r in got], reverse=True)
    assert sorted(got) == sorted((g, a, c, pytest.approx(v), t, pytest.approx(s))
                                 for g, a, c, v, t, s in EXPECTED_P4)


def test_actor_influence_sql_rounds_half_up(spark, lb, imdb):
    tables = {**{k: lb[k] for k in ("movies", "genres")}, **imdb}
    got = rows(mvs.actor_influence_sql(spark, tables))
    assert got[0] == ("Drama", "Ann Actor", 3, 8.37, 14200, 118806.67)
    assert sorted(got) == sorted((g, a, c, round(v + 1e-9, 2), t, round(s + 1e-9, 2))
                                 for g, a, c, v, t, s in EXPECTED_P4)


def test_actor_influence_forms_agree_on_repeated_films_and_credits(spark, lb, imdb):
    movies = lb["movies"].unionByName(lb["movies"].where("rating > 4.2"))
    principals = imdb["principals"].unionByName(imdb["principals"].limit(4))
    args = (movies, lb["genres"], imdb["basics"], imdb["ratings"], principals, imdb["names"])
    keys = ("movies", "genres", "basics", "ratings", "principals", "names")
    sql = {(r[0], r[1]): r[2:] for r in rows(mvs.actor_influence_sql(spark, dict(zip(keys, args))))}
    df = {(r[0], r[1]): r[2:] for r in rows(mv.actor_influence(*args))}
    assert sql.keys() == df.keys() and any(v[0] > 3 for v in df.values())
    for key, (count, mean, votes, score) in df.items():
        assert sql[key] == (count, pytest.approx(mean, abs=0.0051), votes, pytest.approx(score, abs=0.0051))


def test_combine_directory_side_by_side(spark):
    out = mv.combine_directory(spark, os.path.join(FIXTURES, "concat_dir"))
    # actors, genres, movies in name order; id and name come from actors (first wins);
    # description, tagline and minute are dropped from movies.
    assert out.columns == ["id", "name", "role", "genre", "date", "rating"]
    # Rows keep their place in each file; only movies.csv is not sorted by id.
    assert rows(out) == [(10, "Ann Actor", "Lead", "Comedy", 1999, 4.2),
                         (11, "Eve Star", "Support", "Drama", 1999, 4.5),
                         (12, "Dan Director", "Cameo", None, 2001, 4.0),
                         (13, "Zed", "Extra", None, None, None)]
    by_id = mv.combine_directory(spark, os.path.join(FIXTURES, "concat_dir"),
                                 order_by={"genres": ["id"], "movies": ["rating"]})
    assert [r[3:] for r in rows(by_id)] == [("Drama", 2001, 4.0), ("Comedy", 1999, 4.2), (None, 1999, 4.5),
                                            (None, None, None)]


def test_combine_directory_follows_the_files_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n3,c\n1,a\n2,b\n")
    (tmp_path / "b.csv").write_text("p,q\n9,q\n8,p\n7,o\n")
    assert rows(mv.combine_directory(spark, str(tmp_path))) == [(3, "c", 9, "q"), (1, "a", 8, "p"), (2, "b", 7, "o")]


def test_file_order_holds_over_many_splits(spark, tmp_path):
    values = [(i * 7919) % 5000 for i in range(5000)]
    (tmp_path / "long.csv").write_text("v\n" + "\n".join(map(str, values)) + "\n")
    keys = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = spark.read.csv(str(tmp_path / "long.csv"), header=True, schema="v int")
        assert df.rdd.getNumPartitions() > 8
        assert [r[0] for r in rows(concat_columns([df]))] == values
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", list(mv.IMDB_FILES))
def test_imdb_files_bind_by_header(spark, imdb, tmp_path, name):
    file = mv.IMDB_FILES[name][0]
    for key, (other, _) in mv.IMDB_FILES.items():
        lines = [line.split("\t") for line in open(os.path.join(FIXTURES, "imdb", other)).read().splitlines()]
        permuted = [line[::-1] for line in lines] if other == file else lines
        (tmp_path / other).write_text("\n".join("\t".join(line) for line in permuted) + "\n")
    columns = imdb[name].columns
    got = mv.load_imdb(spark, str(tmp_path))[name]
    assert got.columns == columns[::-1]
    assert sorted(rows(got.select(*columns)), key=repr) == sorted(rows(imdb[name]), key=repr)


def test_combine_directory_output_round_trips(spark, tmp_path):
    out = mv.combine_directory(spark, os.path.join(FIXTURES, "concat_dir"))
    target = str(tmp_path / "combined_all_data.csv")
    mv.write_combined(out, target)
    back = spark.read.options(header="true", multiLine="true", escape='"').csv(target)
    assert back.count() == 4 and back.columns == out.columns


def test_combined_table_is_typed_by_header_name(spark, tmp_path):
    src = open(os.path.join(FIXTURES, "combined_all_data.csv")).read().splitlines()
    header = src[0].split(",")
    # Same rows with the first two columns swapped: types must follow the names.
    swapped = ",".join([header[1], header[0]] + header[2:])
    body = []
    for line in src[1:]:
        first, second, rest = line.split(",", 2)
        body.append(",".join([second, first, rest]))
    path = tmp_path / "swapped.csv"
    path.write_text("\n".join([swapped] + body) + "\n")
    df = mv.clean_combined(mv.load_combined(spark, str(path)))
    assert dict(df.dtypes)["year"] == "int" and dict(df.dtypes)["rating"] == "float"
    assert rows(mv.trend_reports(df)["decade_avg_ratings"])[2] == (1990, 4.5)


def test_save_influence_writes_pipe_files_and_replaces_them(spark, lb, imdb, tmp_path):
    from marquee.sources import PIPE_CSV, read_delimited
    out = mv.actor_influence(lb["movies"], lb["genres"], imdb["basics"], imdb["ratings"],
                             imdb["principals"], imdb["names"])
    target = str(tmp_path / "influence")
    mv.save_influence(out, target)
    mv.save_influence(out, target)  # overwrite mode: a second run replaces the first
    text = "".join(open(os.path.join(target, f)).read() for f in sorted(os.listdir(target))
                   if f.endswith(".csv"))
    assert text.startswith("genre|actor_name|movie_count|") and "|" in text
    back = read_delimited(spark, target, PIPE_CSV, schema=out.schema)
    assert sorted(rows(back)) == sorted(rows(out))


def test_to_parquet_then_report_from_parquet(spark, lb, tmp_path):
    target = str(tmp_path / "pq")
    mv.to_parquet({"movies": lb["movies"], "genres": lb["genres"]}, target)
    movies = spark.read.parquet(f"{target}/movies.parquet")
    genres = spark.read.parquet(f"{target}/genres.parquet")
    assert rows(mv.avg_rating_by_genre(movies, genres)) == _approx_rows(EXPECTED_P2A)


def test_register_inputs_exposes_views(spark, lb):
    mvs.register_inputs(spark, {"lb_movies_view": lb["movies"]})
    assert spark.sql("SELECT COUNT(*) FROM lb_movies_view").first()[0] == 14


def test_preview_is_a_limit(spark, lb, imdb):
    from marquee.sources import preview
    out = mv.high_rated_by_year(lb["movies"], imdb["basics"], imdb["ratings"], last=None)
    assert rows(preview(out, 3)) == EXPECTED_P1[:3]


def test_headed_files_read_as_headerless_do_not_fail_or_change_the_report(spark):
    # Each header line becomes a data row: its numbers are NULL under the
    # declared types (no ANSI cast failure) and it drops out of the report.
    imdb = mv.load_imdb(spark, os.path.join(FIXTURES, "imdb"), header=False)
    assert imdb["basics"].count() == 12
    assert rows(mv.avg_rating_by_packed_genre(imdb["basics"], imdb["ratings"])) == \
        _approx_rows(EXPECTED_P2B)


def test_clean_combined_drops_non_finite_years(spark):
    df = spark.createDataFrame([(1999.7, 4.0), (float("nan"), 3.0), (1e20, 2.0), (None, 1.0)],
                               "year float, rating float")
    assert rows(mv.clean_combined(df)) == [(1999, 4.0)]

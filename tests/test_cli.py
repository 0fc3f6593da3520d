"""The command-line runner, driven in-process on the hand-made inputs."""

import os

from conftest import FIXTURES, rows
from marquee.__main__ import run

LB = os.path.join(FIXTURES, "letterboxd")
IMDB = os.path.join(FIXTURES, "imdb")


def test_films_per_year_writes_and_previews_in_order(spark, tmp_path):
    out = str(tmp_path / "fpy")
    previews = run(spark, ["films-per-year", "--letterboxd", LB, "--imdb", IMDB, "--out", out,
                           "--show", "3"])
    assert [r[0] for r in rows(previews["films_per_year"])] == [2015, 2012, 2010]
    assert spark.read.options(header="true").csv(out).count() == 10


def test_influence_sql_uses_the_pipe_profile(spark, tmp_path):
    out = str(tmp_path / "infl")
    previews = run(spark, ["influence", "--letterboxd", LB, "--imdb", IMDB, "--out", out, "--sql"])
    first = rows(previews["influence"])[0]
    assert first[:2] == ("Drama", "Ann Actor") and first[5] == 118806.67
    header = next(l for f in sorted(os.listdir(out)) if f.endswith(".csv")
                  for l in open(os.path.join(out, f)))
    assert header.startswith("genre|actor_name|")


def test_trends_write_one_folder_per_report(spark, tmp_path):
    out = str(tmp_path / "trends")
    run(spark, ["trends", "--combined", os.path.join(FIXTURES, "combined_all_data.csv"),
                "--out", out])
    assert sorted(os.listdir(out)) == ["decade_avg_ratings", "genre_trends",
                                       "top_movies_per_year", "yearly_genre_ratings"]


def test_packed_genre_headerless_and_combine(spark, tmp_path):
    prev = run(spark, ["packed-genre", "--imdb", os.path.join(FIXTURES, "imdb_noheader"),
                       "--no-header", "--out", str(tmp_path / "pg")])
    assert [r[0] for r in rows(prev["packed_genre"])] == ["Action", "Comedy", "Crime", "Drama"]
    prev = run(spark, ["combine", "--dir", os.path.join(FIXTURES, "concat_dir"),
                       "--out", str(tmp_path / "comb")])
    assert prev["combined"].count() == 4


def test_convert_then_report_from_parquet(spark, tmp_path):
    pq = str(tmp_path / "pq")
    assert run(spark, ["convert", "--letterboxd", LB, "--imdb", IMDB, "--out", pq]) == {}
    assert sorted(os.listdir(pq)) == sorted(f"{k}.parquet" for k in (
        "movies", "genres", "actors", "basics", "ratings", "principals", "names"))
    from_csv = run(spark, ["influence", "--letterboxd", LB, "--imdb", IMDB,
                           "--out", str(tmp_path / "a")])
    from_pq = run(spark, ["influence", "--parquet", pq, "--out", str(tmp_path / "b")])
    assert sorted(rows(from_csv["influence"])) == sorted(rows(from_pq["influence"]))


def test_trends_from_converted_combined_table(spark, tmp_path):
    pq = str(tmp_path / "pq")
    run(spark, ["convert", "--combined", os.path.join(FIXTURES, "combined_all_data.csv"),
                "--out", pq])
    prev = run(spark, ["trends", "--parquet", pq, "--out", str(tmp_path / "t")])
    assert rows(prev["decade_avg_ratings"])[0] == (0, 1.0)

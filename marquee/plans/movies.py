"""The four film reports on their native inputs, DataFrame form.

Inputs
------
Letterboxd-style CSV folder: ``movies.csv``, ``genres.csv``, ``actors.csv``
(RFC-4180: quoted fields may hold commas, doubled quotes and newlines).
IMDb-style TSV folder: ``title.basics.tsv``, ``title.ratings.tsv``,
``title.principals.tsv``, ``name.basics.tsv`` (tab, no quoting, ``\\N`` for
missing). Combined CSV: the side-by-side table built by ``combine_directory``.

All inputs are read with declared types (see ``*_SCHEMA``), so a malformed
number becomes NULL instead of failing an ANSI cast, and ``\\N`` is NULL.

For big inputs, convert the CSV/TSV once to Parquet (``to_parquet``) and run
the reports on that: multi-line CSV cannot be split across tasks, Parquet can,
and it gives the reports column pruning and filter pushdown.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, IntegerType, StringType, StructField,
                               StructType)

from marquee.functions.scalar import is_year_text, to_int
from marquee.operators import (EXACT, all_of, avg_by_key, avg_by_packed_key, bucket_of_states, concat_columns,
                               drop_nulls, era_of_states, exact_mean, mean_states, score_by_label,
                               stats_of_states, top_n_by_rank, two_source_counts)
from marquee.sources import (IMDB_TSV, IMDB_TSV_HEADERLESS, PIPE_CSV, RFC4180_CSV, Profile,
                             read_by_header, read_delimited, read_directory, write_delimited)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, D = StringType(), IntegerType(), DoubleType()

# The column names and order of the input files (as the
# files define them); the types are the ones we declare. ``date`` stays
# text: it is checked against the four-digit year rule before it becomes a
# number.
MOVIES_SCHEMA = _schema(("id", I), ("name", S), ("date", S), ("tagline", S),
                        ("description", S), ("minute", I), ("rating", D))
GENRES_SCHEMA = _schema(("id", I), ("genre", S))
ACTORS_SCHEMA = _schema(("id", I), ("name", S), ("role", S))
BASICS_SCHEMA = _schema(("tconst", S), ("titleType", S), ("primaryTitle", S),
                        ("originalTitle", S), ("isAdult", I), ("startYear", I), ("endYear", I),
                        ("runtimeMinutes", I), ("genres", S))
RATINGS_SCHEMA = _schema(("tconst", S), ("averageRating", D), ("numVotes", I))
PRINCIPALS_SCHEMA = _schema(("tconst", S), ("ordering", I), ("nconst", S), ("category", S),
                            ("job", S), ("characters", S))
NAMES_SCHEMA = _schema(("nconst", S), ("primaryName", S), ("birthYear", I), ("deathYear", I),
                       ("primaryProfession", S), ("knownForTitles", S))
# The combined table's declared types (bound by header name when read).
COMBINED_SCHEMA = _schema(("id", S), ("country", S), ("title", S), ("year", FloatType()),
                          ("rating", FloatType()), ("name", S), ("role", S), ("theme", S),
                          ("genre", S), ("date", S), ("type", S), ("studio", S),
                          ("language", S))

LETTERBOXD_FILES = {"movies": ("movies.csv", MOVIES_SCHEMA),
                    "genres": ("genres.csv", GENRES_SCHEMA),
                    "actors": ("actors.csv", ACTORS_SCHEMA)}
IMDB_FILES = {"basics": ("title.basics.tsv", BASICS_SCHEMA),
              "ratings": ("title.ratings.tsv", RATINGS_SCHEMA),
              "principals": ("title.principals.tsv", PRINCIPALS_SCHEMA),
              "names": ("name.basics.tsv", NAMES_SCHEMA)}


# ---------------------------------------------------------------- loading

def load_letterboxd(spark: SparkSession, directory: str,
                    profile: Profile = RFC4180_CSV) -> dict[str, DataFrame]:
    """movies / genres / actors, typed by header name (column order may vary)."""
    root = directory.rstrip("/")
    return {key: read_by_header(spark, f"{root}/{fname}", profile, schema)
            for key, (fname, schema) in LETTERBOXD_FILES.items()}


def load_imdb(spark: SparkSession, directory: str, header: bool = True) -> dict[str, DataFrame]:
    """basics / ratings / principals / names, typed by header name (column order
    may vary). ``header=False`` for files without a header line: columns are
    then named by position from the declared schema."""
    root = directory.rstrip("/")
    if header:
        return {key: read_by_header(spark, f"{root}/{fname}", IMDB_TSV, schema)
                for key, (fname, schema) in IMDB_FILES.items()}
    return {key: read_delimited(spark, f"{root}/{fname}", IMDB_TSV_HEADERLESS, schema=schema)
            for key, (fname, schema) in IMDB_FILES.items()}


def load_combined(spark: SparkSession, path: str, by_header: bool = True) -> DataFrame:
    """The combined table, typed by header name (its column order depends on
    which files the prep step found). ``by_header=False`` binds the declared
    schema by position instead, for files known to follow it exactly."""
    if by_header:
        return read_by_header(spark, path, RFC4180_CSV, COMBINED_SCHEMA)
    return read_delimited(spark, path, RFC4180_CSV, schema=COMBINED_SCHEMA)


def to_parquet(tables: Mapping[str, DataFrame], directory: str, mode: str = "errorifexists") -> None:
    """Write each table once as Parquet (``<directory>/<name>.parquet``)."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{directory.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------- P1: films per year

def letterboxd_high_rated(movies: DataFrame, min_rating: float = 4) -> DataFrame:
    """``year`` (int) of every complete film rated >= min_rating whose date is a
    four-digit year."""
    complete = all_of(F.col(c).isNotNull() for c in ("id", "name", "rating", "date"))
    wanted = complete & is_year_text("date") & (F.col("rating") >= min_rating)
    return movies.where(wanted).select(to_int("date").alias("year"))


def imdb_high_rated(basics: DataFrame, ratings: DataFrame, min_rating: float = 8,
                    min_votes: int = 2100) -> DataFrame:
    """``tconst, year`` of titled movies with a year, rated >= min_rating by at
    least min_votes voters."""
    movies_only = all_of([F.col("titleType") == "movie", F.col("tconst").isNotNull(),
                          F.col("primaryTitle").isNotNull(), F.col("startYear").isNotNull()])
    films = basics.where(movies_only).select("tconst", F.col("startYear").alias("year"))
    liked = ratings.where((F.col("averageRating") >= min_rating)
                          & (F.col("numVotes") >= min_votes)).select("tconst")
    return films.join(liked, "tconst", "inner")


def high_rated_by_year(movies: DataFrame, basics: DataFrame, ratings: DataFrame,
                       last: int | None = 10) -> DataFrame:
    """year, count_letterboxd, count_imdb for the latest ``last`` years (all if None)."""
    out = two_source_counts(letterboxd_high_rated(movies), imdb_high_rated(basics, ratings),
                            "year", "count_letterboxd", "count_imdb")
    return out.limit(last) if last is not None else out


# ---------------------------------------------- P2: mean rating per genre

def avg_rating_by_genre(movies: DataFrame, genres: DataFrame, min_minutes: int = 60) -> DataFrame:
    """genre, avg_rating over films of >= min_minutes (child genre table)."""
    long_films = movies.where(F.col("minute") >= min_minutes).select("id", "rating")
    return avg_by_key(long_films, genres, "id", "genre", "rating", "avg_rating", mean=exact_mean)


# Fixed value: the genre left out of the packed-genre report.
EXCLUDED_GENRE = "Short"


def avg_rating_by_packed_genre(basics: DataFrame, ratings: DataFrame,
                               min_minutes: int = 60) -> DataFrame:
    """genre, avg_rating over titles of >= min_minutes (comma-packed genres)."""
    titles = basics.filter(F.col("runtimeMinutes") >= min_minutes).select("tconst", "genres")
    return avg_by_packed_key(titles, ratings.select("tconst", "averageRating"), "tconst",
                             "genres", "averageRating", sep=",", exclude=[EXCLUDED_GENRE],
                             group="genre", out="avg_rating", exact=EXACT)


# ------------------------------------------------------ P3: trend reports

def clean_combined(df: DataFrame) -> DataFrame:
    """Year truncated to a whole number; rows lacking a rating or a year dropped.

    A year that is not a finite number in int range becomes NULL (try-cast)
    and is dropped with the rest, instead of failing the job under ANSI.
    """
    return drop_nulls(df.withColumn("year", F.col("year").try_cast("int")), ["year", "rating"])


# The trend pack's report names and output column names
# (yearly_genre_ratings: year, genre, avg_rating, movie_count;
# top_movies_per_year: year, title, genre, rating, rank;
# decade_avg_ratings: decade, avg_rating_decade;
# genre_trends: genre, avg_pre_2000, avg_post_2000, rating_change).
def trend_states(df: DataFrame) -> DataFrame:
    """Rating sums and counts by year and genre, which three of the trend reports are made of."""
    return mean_states(df, ["year", "genre"], "rating")


def trend_reports(df: DataFrame, top_n: int = 5, states: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four trend reports over a cleaned combined table (lazy DataFrames).

    Three are rolled up from ``states`` (default: ``trend_states(df)``). In one
    query they share the states' scan; pass checkpointed states to share it
    between queries.
    """
    states = trend_states(df) if states is None else states
    top = (top_n_by_rank(df, "year", "rating", top_n)
           .select("year", "title", "genre", "rating", "rank")
           .orderBy("year", "rank", "title"))
    return {
        "yearly_genre_ratings": stats_of_states(states, ["year", "genre"], "avg_rating", "movie_count"),
        "top_movies_per_year": top,
        "decade_avg_ratings": bucket_of_states(states, "year", 10, "trunc", "decade", "avg_rating_decade"),
        "genre_trends": era_of_states(states, "genre", "year", 2000, "avg_pre_2000", "avg_post_2000",
                                      "rating_change"),
    }


# ------------------------------------------- P3 prep: side-by-side tables

def combine_directory(spark: SparkSession, directory: str,
                      order_by: Mapping[str, list[str]] | None = None,
                      exclude: tuple[str, ...] = ("combined_all_data",),
                      schemas: Mapping[str, StructType] | None = None) -> DataFrame:
    """Every CSV of a folder glued side by side by row position.

    Tables are taken in file-name order; a table's rows keep their place in its
    file unless ``order_by`` names columns to sort it by. From ``movies`` the
    description, tagline and minute columns are dropped; a repeated column
    name keeps the first table's column; shorter tables are NULL-padded.
    ``schemas`` spares the inference pass over the tables it names.
    """
    tables = read_directory(spark, directory, RFC4180_CSV, exclude=exclude, schemas=schemas)
    order_by = order_by or {}
    return concat_columns(list(tables.values()), [order_by.get(n) for n in tables])


def write_combined(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_delimited(df, path, RFC4180_CSV, mode=mode)


# ------------------------------------------------------ P4: actor influence

# Ratings have one decimal; as decimals their sums are the same in any row order.
RATING = "DECIMAL(9, 4)"


def actor_credits(movies: DataFrame, genres: DataFrame, basics: DataFrame, ratings: DataFrame,
                  principals: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """genre, nconst, averageRating, numVotes, credits per (film, title, genre, person).

    Films rated > min_rating meet IMDb titles on name AND year, then ratings
    and principals (every category). A person's credits on a title are counted
    before the principals are joined, so a film's genres multiply one row a
    person; a film with several genres contributes a row for each. Films are
    the shared side of two chains, titles and genres, that meet at the end.
    """
    films = movies.where(F.col("rating") > min_rating).select(
        "id", F.col("name").alias("primaryTitle"), to_int("date").alias("startYear"))
    credits = principals.groupBy("tconst", "nconst").agg(F.count(F.lit(1)).alias("credits"))
    people = (films.join(basics.select("tconst", "primaryTitle", "startYear"), ["primaryTitle", "startYear"])
              .select("id", "tconst")
              .join(ratings.withColumn("averageRating", F.col("averageRating").try_cast(RATING)), "tconst")
              .join(credits, "tconst")
              .select("id", "nconst", "averageRating", "numVotes", "credits"))
    film_genres = films.select("id").join(genres, "id")
    return people.join(film_genres, "id").select("genre", "nconst", "averageRating", "numVotes", "credits")


def actor_influence(movies: DataFrame, genres: DataFrame, basics: DataFrame, ratings: DataFrame,
                    principals: DataFrame, names: DataFrame, min_rating: float = 4.0) -> DataFrame:
    """genre, actor_name, movie_count, avg_rating, total_votes, influence_score
    (fixed output names); sorted by influence_score descending.

    Credits are reduced per (genre, person id) before the names are joined, then combined per (genre, name): people sharing a name form one
    group, as when grouping by the name directly.
    """
    credits = actor_credits(movies, genres, basics, ratings, principals, min_rating)
    return (score_by_label(credits, "genre", "nconst", names, "nconst", "primaryName",
                           rating="averageRating", weight="numVotes", times="credits", label_name="actor_name",
                           count_name="movie_count", avg_name="avg_rating",
                           total_name="total_votes", score_name="influence_score", divide_as="double")
            .orderBy(F.col("influence_score").desc()))


def save_influence(df: DataFrame, path: str) -> None:
    """Pipe-delimited UTF-8 output with header, replacing earlier results."""
    write_delimited(df, path, PIPE_CSV, mode="overwrite")

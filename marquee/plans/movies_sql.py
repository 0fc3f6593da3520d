"""The four film reports as Spark SQL text (same inputs as ``movies``).

Every report is one of the builders of ``operators.sql_forms`` over the film
tables; the benchmark twins bind the same builders to other tables. Tables are
bound per call (``spark.sql(text, movies=df, ...)``), so nothing leaks into the
session catalog; ``register_inputs`` exists for callers who want named views.

Where text meets a number the queries use TRY_CAST, so a malformed value is
NULL instead of an ANSI cast failure.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.scalar import YEAR_PATTERN
from marquee.operators import sql_forms
from marquee.plans.movies import EXCLUDED_GENRE
from marquee.sources.tables import register_views

_YEAR = YEAR_PATTERN.replace("{", "{{").replace("}", "}}")

HIGH_RATED_BY_YEAR = sql_forms.two_source_counts_sql(
    f"""(SELECT TRY_CAST(date AS INT) AS year FROM {{movies}}
               WHERE id IS NOT NULL AND name IS NOT NULL AND rating >= 4 AND date RLIKE '{_YEAR}')""",
    """(SELECT startYear AS year FROM {basics} JOIN {ratings} USING (tconst)
               WHERE titleType = 'movie' AND primaryTitle IS NOT NULL AND startYear IS NOT NULL
                 AND averageRating >= 8 AND numVotes >= 2100)""",
    "year", "count_letterboxd", "count_imdb")


def high_rated_by_year_sql(spark: SparkSession, movies: DataFrame, basics: DataFrame,
                           ratings: DataFrame, last: int | None = 10) -> DataFrame:
    text = HIGH_RATED_BY_YEAR + (f"\nLIMIT {int(last)}" if last is not None else "")
    return spark.sql(text, movies=movies, basics=basics, ratings=ratings)


def avg_rating_by_genre_sql(spark: SparkSession, movies: DataFrame, genres: DataFrame) -> DataFrame:
    text = sql_forms.avg_by_key_sql("(SELECT id, rating FROM {movies} WHERE minute >= 60)", "{genres}", "id",
                                    "genre", "rating", "avg_rating", sql_forms.exact_mean)
    return spark.sql(text, movies=movies, genres=genres)


def avg_rating_by_packed_genre_sql(spark: SparkSession, basics: DataFrame,
                                   ratings: DataFrame) -> DataFrame:
    text = sql_forms.avg_by_packed_key_sql("(SELECT tconst, genres FROM {basics} WHERE runtimeMinutes >= 60)",
                                           "{ratings}", "tconst", "genres", "averageRating", ",", EXCLUDED_GENRE,
                                           "genre", "avg_rating", sql_forms.EXACT)
    return spark.sql(text, basics=basics, ratings=ratings)


def trend_states_sql(spark: SparkSession, movies: DataFrame) -> DataFrame:
    """Rating sums and counts by year and genre, which three of the trend reports are made of."""
    return spark.sql(sql_forms.mean_states_sql("{movies}", ["year", "genre"], "rating"), movies=movies)


def trend_reports_sql(spark: SparkSession, movies: DataFrame, states: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four trend reports as SQL over a cleaned combined table, three of them from shared states.

    The decade here floors (bigint); the DataFrame form truncates toward zero
    (int). They differ only for negative years.
    """
    texts = {
        "yearly_genre_ratings_sql": sql_forms.stats_of_states_sql(
            "{states}", ["year", "genre"], "avg_rating", "movie_count"),
        "top_movies_per_year_sql": sql_forms.top_n_per_group_sql(
            "{movies}", ["year", "title", "genre", "rating"], "year", "rating", 5, "rank"),
        "decade_avg_ratings_sql": sql_forms.bucket_of_states_sql(
            "{states}", "year", 10, "decade", "avg_rating_decade"),
        "genre_trends_sql": sql_forms.era_of_states_sql(
            "{states}", "genre", "year", 2000, "avg_pre_2000", "avg_post_2000", "rating_change"),
    }
    bound = {"movies": movies, "states": trend_states_sql(spark, movies) if states is None else states}
    return {name: spark.sql(text, **{k: df for k, df in bound.items() if f"{{{k}}}" in text})
            for name, text in texts.items()}


# Credits per (film, person), then per genre of the film: films are the shared
# side of both chains, as in ``actor_credits``.
_CREDITS = """(
            WITH films AS (
                SELECT id, name AS primaryTitle, TRY_CAST(date AS INT) AS startYear FROM {movies} WHERE rating > 4.0
            ),
            people AS (
                SELECT id, nconst, averageRating, numVotes, credits
                FROM films JOIN (SELECT tconst, primaryTitle, startYear FROM {basics}) USING (primaryTitle, startYear)
                     JOIN (SELECT tconst, TRY_CAST(averageRating AS DECIMAL(9, 4)) AS averageRating, numVotes
                           FROM {ratings}) USING (tconst)
                     JOIN (SELECT tconst, nconst, COUNT(*) AS credits FROM {principals} GROUP BY tconst, nconst)
                          USING (tconst)
            )
            SELECT genre, nconst, averageRating, numVotes, credits
            FROM people JOIN (SELECT id, genre FROM films JOIN {genres} USING (id)) USING (id))"""

ACTOR_INFLUENCE = sql_forms.score_by_label_sql(
    _CREDITS, "genre", "nconst", "{names}", "nconst", "primaryName", "averageRating", "numVotes", "actor_name",
    "movie_count", "avg_rating", "total_votes", "influence_score", digits=2, times="credits")


def actor_influence_sql(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Influence per (genre, actor) with mean and score rounded half-up to 2 digits.

    ``tables`` needs movies, genres, basics, ratings, principals, names.
    """
    keys = ("movies", "genres", "basics", "ratings", "principals", "names")
    found = spark.sql(ACTOR_INFLUENCE, **{k: tables[k] for k in keys})
    return found.withColumns({c: F.col(c).cast("double") for c in ("avg_rating", "influence_score")})


def register_inputs(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Register loaded inputs as session views under their keys."""
    register_views(spark, dict(tables))

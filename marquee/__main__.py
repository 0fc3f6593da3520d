"""Run one film report from the command line.

    python -m marquee films-per-year   --letterboxd DIR --imdb DIR --out PATH [--sql]
    python -m marquee genre-rating     --letterboxd DIR --out PATH [--sql]
    python -m marquee packed-genre     --imdb DIR [--no-header] --out PATH [--sql]
    python -m marquee trends           --combined FILE --out DIR [--sql]
    python -m marquee influence        --letterboxd DIR --imdb DIR --out PATH [--sql]
    python -m marquee combine          --dir DIR --out PATH
    python -m marquee convert          [--letterboxd DIR] [--imdb DIR] [--combined FILE] --out DIR

``convert`` writes every input table once as Parquet (``<out>/<name>.parquet``);
the reports then read that folder with ``--parquet DIR`` instead of
``--letterboxd``/``--imdb``: splittable, column-pruned, filter-pushed scans.

The session comes from ``SparkSession.builder.getOrCreate()``, so master and
cluster settings are whatever ``spark-submit`` (or the environment) gives;
Spark's web UI stays off unless ``--spark-ui`` is passed.
Results are written once (CSV with header; the influence report with the
pipe profile) and previewed from the written files. ``trends`` writes one
folder per report under ``--out``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import movies as mv
from marquee.plans import movies_sql as mvs
from marquee.sources import PIPE_CSV, PLAIN_CSV, RFC4180_CSV, write_then_preview


# Each report's own order, re-applied to previews read back from the output.
PREVIEW_ORDER = {
    "films_per_year": [("year", True)],
    "genre_rating": [("genre", False)],
    "packed_genre": [("genre", False)],
    "yearly_genre_ratings": [("year", False), ("avg_rating", True), ("genre", False)],
    "top_movies_per_year": [("year", False), ("rank", False), ("title", False)],
    "decade_avg_ratings": [("decade", False)],
    "genre_trends": [("rating_change", True), ("genre", False)],
    "influence": [("influence_score", True), ("genre", False), ("actor_name", False)],
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m marquee", description=__doc__.split("\n")[0])
    p.add_argument("report", choices=["films-per-year", "genre-rating", "packed-genre", "trends",
                                      "influence", "combine", "convert"])
    p.add_argument("--letterboxd", help="folder with movies.csv, genres.csv, actors.csv")
    p.add_argument("--imdb", help="folder with the title/name TSV files")
    p.add_argument("--no-header", action="store_true", help="IMDb TSV files lack a header line")
    p.add_argument("--parquet", help="folder written by `convert` (replaces the CSV/TSV inputs)")
    p.add_argument("--combined", help="combined CSV file for the trend reports")
    p.add_argument("--dir", help="folder of CSV files to combine side by side")
    p.add_argument("--out", required=True, help="output path (a folder of part files)")
    p.add_argument("--sql", action="store_true", help="run the SQL form of the report")
    p.add_argument("--mode", default="errorifexists", help="write mode (default: errorifexists)")
    p.add_argument("--show", type=int, default=20, help="rows to preview after writing")
    p.add_argument("--spark-ui", action="store_true",
                   help="start Spark's web UI (off by default: it opens a port)")
    return p


def _need(args, *names):
    missing = [n for n in names if not getattr(args, n)]
    if missing:
        raise SystemExit(f"{args.report} needs --{' --'.join(missing)}")


def _letterboxd(spark: SparkSession, args) -> dict[str, DataFrame]:
    if args.parquet:
        return {k: spark.read.parquet(f"{args.parquet.rstrip('/')}/{k}.parquet")
                for k in mv.LETTERBOXD_FILES}
    _need(args, "letterboxd")
    return mv.load_letterboxd(spark, args.letterboxd)


def _imdb(spark: SparkSession, args) -> dict[str, DataFrame]:
    if args.parquet:
        return {k: spark.read.parquet(f"{args.parquet.rstrip('/')}/{k}.parquet")
                for k in mv.IMDB_FILES}
    _need(args, "imdb")
    return mv.load_imdb(spark, args.imdb, not args.no_header)


def run(spark: SparkSession, argv: list[str]) -> dict[str, DataFrame]:
    """Run the report named in ``argv``; return the previews (already written)."""
    args = _parser().parse_args(argv)
    results: dict[str, DataFrame] = {}
    profile = PLAIN_CSV
    if args.report == "convert":
        tables: dict[str, DataFrame] = {}
        if args.letterboxd:
            tables.update(mv.load_letterboxd(spark, args.letterboxd))
        if args.imdb:
            tables.update(mv.load_imdb(spark, args.imdb, not args.no_header))
        if args.combined:
            tables["combined"] = mv.load_combined(spark, args.combined)
        if not tables:
            raise SystemExit("convert needs --letterboxd, --imdb and/or --combined")
        mv.to_parquet(tables, args.out, mode=args.mode)
        return {}
    if args.report == "films-per-year":
        lb, imdb = _letterboxd(spark, args), _imdb(spark, args)
        results["films_per_year"] = (
            mvs.high_rated_by_year_sql(spark, lb["movies"], imdb["basics"], imdb["ratings"])
            if args.sql else mv.high_rated_by_year(lb["movies"], imdb["basics"], imdb["ratings"]))
    elif args.report == "genre-rating":
        lb = _letterboxd(spark, args)
        results["genre_rating"] = (mvs.avg_rating_by_genre_sql(spark, lb["movies"], lb["genres"])
                                   if args.sql else
                                   mv.avg_rating_by_genre(lb["movies"], lb["genres"]))
    elif args.report == "packed-genre":
        imdb = _imdb(spark, args)
        results["packed_genre"] = (
            mvs.avg_rating_by_packed_genre_sql(spark, imdb["basics"], imdb["ratings"])
            if args.sql else mv.avg_rating_by_packed_genre(imdb["basics"], imdb["ratings"]))
    elif args.report == "trends":
        if args.parquet:
            combined = spark.read.parquet(f"{args.parquet.rstrip('/')}/combined.parquet")
        else:
            _need(args, "combined")
            combined = mv.load_combined(spark, args.combined)
        clean = mv.clean_combined(combined)
        results = mvs.trend_reports_sql(spark, clean) if args.sql else mv.trend_reports(clean)
    elif args.report == "influence":
        tables = {**_letterboxd(spark, args), **_imdb(spark, args)}
        results["influence"] = (mvs.actor_influence_sql(spark, tables) if args.sql else
                                mv.actor_influence(*(tables[k] for k in (
                                    "movies", "genres", "basics", "ratings", "principals",
                                    "names"))))
        profile = PIPE_CSV
    else:
        _need(args, "dir")
        results["combined"] = mv.combine_directory(spark, args.dir)
        profile = RFC4180_CSV
    previews = {}
    for name, df in results.items():
        path = args.out if len(results) == 1 else f"{args.out.rstrip('/')}/{name}"
        order = [F.col(c).desc() if desc else F.col(c).asc()
                 for c, desc in PREVIEW_ORDER.get(name.removesuffix("_sql"), [])]
        previews[name] = write_then_preview(df, path, profile, args.show, order_by=order,
                                            mode=args.mode)
    return previews


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    args = _parser().parse_args(argv)  # --help and usage errors exit before a session starts
    spark = (SparkSession.builder.appName("marquee")
             .config("spark.ui.enabled", "true" if args.spark_ui else "false")
             .getOrCreate())
    for name, preview in run(spark, argv).items():
        print(f"== {name}")
        preview.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

"""Command line jobs: ``spark-submit run_job.py <job> ...``.

    forecast  history files -> forecast file (trains the model if none is saved)
    evaluate  history files -> yearly metrics, error map and heat tables
    maps      history files -> map feed by year; forecast file -> forecast feed
    check     forecast file -> counts and days of the valid rows
    sweep     history files -> inertia and silhouette per number of clusters
    year      map feed -> the points of one year, or of the latest one
    numbers   history files -> values per file and column that are no numbers
    merge     history files -> merged table; only files that are new are parsed
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from georisk.operators.cleaning import clean_counts, coerce_text, drop_repeated_header, present
from georisk.operators.models import all_features, best_k, kmeans_sweep
from georisk.operators.profile import date_range, distinct_places, edge_days, history_report
from georisk.operators.risk import (
    cluster_counts,
    forecast_by_month,
    forecast_output,
    forecast_summary,
)
from georisk.functions.scalars import all_of
from georisk.plans.evaluation import MAP_YEAR, run_evaluation
from georisk.plans.forecast import load_or_train, run_forecast
from georisk.plans.yearly_maps import (
    DEFAULT_YEAR,
    build_forecast_map,
    build_yearly_maps,
    read_year,
)
from georisk.roles import DEFAULT_ROLES
from georisk.sources.forecast import load_forecast_text, scan_forecast_text
from georisk.sources.merged import load_merged, merge_files
from georisk.sources.occurrences import unparsed_counts
from georisk.workspace import build_session, drop_settled, settle


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="georisk")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def merging(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--refresh", action="store_true", help="parse all files anew")
        sub.add_argument("--quarantine", help="folder for rows with bad numbers, which fail the job otherwise")

    for name in ("forecast", "evaluate"):
        sub = job(name, "files", "merged", "model", "out")
        merging(sub)
        sub.add_argument("--trees", type=int, default=200)
        sub.add_argument("--depth", type=int, default=20)
        if name == "forecast":
            sub.add_argument("--year", type=int, default=2026)
            sub.add_argument("--total", type=int)
            sub.add_argument("--seed", type=int, default=4224)
        else:
            sub.add_argument("--year", type=int, default=MAP_YEAR)
            sub.add_argument("--sample", type=int, help="at most this many points on the error map")
            sub.add_argument("--key", help="column that draws the sample")
    job("maps", "files", "out").add_argument("--forecast")
    job("check", "forecast")
    merging(job("sweep", "files", "merged", "out"))
    merging(job("merge", "files", "merged"))
    job("year", "feed", "out").add_argument("--year", type=int, default=DEFAULT_YEAR)
    job("numbers", "files", "out")
    return top


def merged_history(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    return load_merged(
        spark, options.files, options.merged, refresh=options.refresh, quarantine=options.quarantine
    )


def forecast_job(spark: SparkSession, options: argparse.Namespace) -> None:
    history = merged_history(spark, options)
    history_report(history).orderBy(DEFAULT_ROLES.month).show()
    bundle = load_or_train(
        spark, options.model, history, trees=options.trees, depth=options.depth
    )
    result = run_forecast(
        history, bundle, options.out, year=options.year, total=options.total, seed=options.seed
    )
    final = forecast_output(result)
    date_range(final, DEFAULT_ROLES.date).show()
    distinct_places(final).show()
    forecast_by_month(final).orderBy(DEFAULT_ROLES.month).show()
    forecast_summary(result).show()
    # As many rows as there are different scores: a table and no print-out.
    cluster_counts(result).write.mode("overwrite").parquet(f"{options.out.rstrip('/')}_clusters")


def evaluate_job(spark: SparkSession, options: argparse.Namespace) -> None:
    history = merged_history(spark, options)
    bundle = load_or_train(
        spark, options.model, history, trees=options.trees, depth=options.depth
    )
    scores = run_evaluation(
        history, bundle, options.out, options.year, sample=options.sample, key=options.key
    )
    scores.orderBy(DEFAULT_ROLES.year).show(scores.count(), truncate=False)
    spark.read.parquet(f"{options.out}/holdout").show(truncate=False)


def maps_job(spark: SparkSession, options: argparse.Namespace) -> None:
    build_yearly_maps(spark, options.files, f"{options.out}/years")
    if options.forecast:
        build_forecast_map(spark, options.forecast, f"{options.out}/forecast")


def check_job(spark: SparkSession, options: argparse.Namespace) -> None:
    roles = DEFAULT_ROLES
    typed = coerce_text(drop_repeated_header(scan_forecast_text(spark, options.forecast)))
    valid = all_of([present(typed, name) for name in (roles.lat, roles.lon, roles.date)])
    clean_counts(typed, valid).show()
    rows = settle(load_forecast_text(spark, options.forecast), "checked")
    edge_days(rows, roles.date).orderBy("day").show()


def sweep_job(spark: SparkSession, options: argparse.Namespace) -> None:
    history = merged_history(spark, options)
    found = settle(kmeans_sweep(*all_features(history)), "sweep")
    found.write.mode("overwrite").parquet(options.out)
    found.orderBy("k").show(found.count(), truncate=False)
    best_k(found).show(truncate=False)


def year_job(spark: SparkSession, options: argparse.Namespace) -> None:
    read_year(spark, options.feed, options.year).write.mode("overwrite").parquet(options.out)


def numbers_job(spark: SparkSession, options: argparse.Namespace) -> None:
    unparsed_counts(spark, options.files).write.mode("overwrite").parquet(options.out)


def merge_job(spark: SparkSession, options: argparse.Namespace) -> None:
    count = merge_files(
        spark, options.files, options.merged, refresh=options.refresh, quarantine=options.quarantine
    )
    print(f"{count} files merged")


JOBS = {
    "forecast": forecast_job, "evaluate": evaluate_job, "maps": maps_job, "check": check_job,
    "sweep": sweep_job, "year": year_job, "numbers": numbers_job, "merge": merge_job,
}


def main(arguments: Sequence[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = build_session(f"georisk-{options.job}")
    try:
        JOBS[options.job](spark, options)
    finally:
        drop_settled(spark)


if __name__ == "__main__":
    main()

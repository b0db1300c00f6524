"""Yearly maps: one feed partitioned by year, and the year a reader asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from georisk.operators.cleaning import year_or_latest
from georisk.operators.feeds import forecast_map_feed, yearly_map_feed
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.sinks import write_feed
from georisk.sources.forecast import scan_forecast
from georisk.sources.occurrences import load_yearly
from georisk.workspace import settle

DEFAULT_YEAR = 2025  # fixed value: the year shown first


def build_yearly_maps(
    spark: SparkSession, pattern: str, out: str, roles: Roles = DEFAULT_ROLES
) -> None:
    # Parsed once: the feed reads the rows for their years and for their points.
    rows = settle(load_yearly(spark, pattern, roles), "yearly")
    write_feed(yearly_map_feed(rows, roles), out)


def read_year(spark: SparkSession, feed: str, wanted: int = DEFAULT_YEAR) -> DataFrame:
    return year_or_latest(spark.read.parquet(feed), "ano", wanted)


def build_forecast_map(
    spark: SparkSession, forecast: str, out: str, roles: Roles = DEFAULT_ROLES
) -> None:
    feed = forecast_map_feed(scan_forecast(spark, forecast, roles), roles)
    feed.write.mode("overwrite").parquet(out)

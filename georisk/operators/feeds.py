"""Tables behind the yearly maps and the forecast map."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from georisk.operators.lookup import lookup
from georisk.roles import DEFAULT_ROLES, Roles


def modal_year(df: DataFrame, source: str, time: str) -> DataFrame:
    """Most frequent year per source, the smaller one on ties, null if unknown.

    Years are counted per source first, so a source of any size reaches the
    second step as one row per year.
    """
    counts = df.groupBy(source, F.year(time).alias("__year")).agg(F.count(F.lit(1)).alias("__n"))
    best = F.max(
        F.when(F.col("__year").isNotNull(), F.struct(F.col("__n"), (-F.col("__year")).alias("neg")))
    )
    return counts.groupBy(source).agg((-best["neg"]).alias("ano"))


def yearly_map_feed(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Map points with the modal year of their file, time cut to midnight."""
    dated = df.withColumn(roles.time, F.col(roles.date).cast("timestamp_ntz"))
    years = modal_year(dated, roles.source, roles.time)
    points = dated.select(
        roles.source, *roles.place, roles.time, roles.risk, roles.dry_days,
        roles.precip, roles.frp,
    )
    return lookup(points, years, [roles.source])


def years_in_order(feed: DataFrame) -> DataFrame:
    """Years of a feed for the year list, an unknown year first."""
    return feed.select("ano").distinct().orderBy(F.coalesce("ano", F.lit(0)))


def forecast_map_feed(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Forecast points with hover columns; the time column holds the date."""
    return df.select(
        *roles.place, roles.risk, F.to_date(roles.date).alias(roles.time),
        roles.dry_days, roles.precip, roles.frp,
    )

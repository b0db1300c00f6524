"""What the history looks like: by month, by month and region, by place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from georisk.functions import scalars as S
from georisk.functions.scalars import nan_to_null
from georisk.operators.cleaning import as_timestamp, drop_missing, present
from georisk.operators.lookup import row_bytes
from georisk.operators.ordering import global_rank
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.workspace import settle


def with_month(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    name = roles.date if roles.date in df.columns else roles.time
    return df.withColumn(roles.month, F.month(as_timestamp(df, name)))


def month_share(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Occurrences per month and their share of the total; at most 12 rows."""
    counts = with_month(df, roles).filter(F.col(roles.month).isNotNull())
    return _share(counts.groupBy(roles.month).agg(F.count(F.lit(1)).alias("count")))


def _share(counts: DataFrame) -> DataFrame:
    everything = Window.partitionBy()  # 12 rows at most
    share = F.col("count").cast("double") / F.sum("count").over(everything)
    return counts.withColumn("share", share)


def month_region_stats(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Mean of each measure by month and region."""
    dated = with_month(df, roles).filter(
        F.col(roles.month).isNotNull() & F.col(roles.region).isNotNull()
    )
    return dated.groupBy(roles.month, roles.region).agg(
        *[F.avg(nan_to_null(name)).alias(name) for name in roles.measures]
    )


def coord_frequency(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Occurrences per place and its names."""
    return (
        drop_missing(df, roles.place)
        .groupBy(*roles.place)
        .agg(F.count(F.lit(1)).alias(roles.frequency))
    )


def hotspot_rank(frequency: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """0-based ``rank`` by falling frequency; ties by place, so it is total."""
    order = [F.col(roles.frequency).desc(), *[F.col(name) for name in roles.place]]
    return global_rank(frequency, order, "rank")


def hotspot_pool(places: int) -> int:
    """The first third of the places, but never none."""
    return max(1, places // 3)


def top_hotspots(ranked: DataFrame, places: int) -> DataFrame:
    return ranked.filter(F.col("rank") < hotspot_pool(places))


def bounding_box(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, more: Sequence[Column] = ()
) -> DataFrame:
    """Bounds of all places, with ``more`` aggregates taken in the same pass."""
    lat, lon = nan_to_null(roles.lat), nan_to_null(roles.lon)
    return df.agg(
        F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"),
        *more,
    )


def distinct_places(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Number of distinct pairs, counting pairs with a null like any other."""
    pairs = df.select(roles.lat, roles.lon).distinct()
    return pairs.agg(F.count(F.lit(1)).alias("places"))


def date_range(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def edge_days(df: DataFrame, time: str, each: int = 3) -> DataFrame:
    """Number of distinct days, with the first and the last few of them."""
    days = settle(df.select(F.to_date(time).alias("day")).dropna().distinct(), "days")
    total = days.agg(F.count(F.lit(1))).scalar()
    first = days.orderBy("day").limit(each).withColumn("edge", F.lit("first"))
    last = days.orderBy(F.col("day").desc()).limit(each).withColumn("edge", F.lit("last"))
    return first.unionByName(last).withColumn("distinct_days", total)


@dataclass(frozen=True)
class Profile:
    """What a scenario needs of one history, with the sizes already measured."""

    rows: int
    shares: DataFrame  # month, count, share; at most 12 rows
    stats: DataFrame  # month, region, mean of each measure
    stats_size: int
    places: DataFrame  # place columns, frequency, rank
    places_size: int
    place_count: int
    bounds: Row  # lat_min, lat_max, lon_min, lon_max


def profile_history(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> Profile:
    """Profile a history in two passes over it.

    The month shares are summed up from the (month, region) aggregate and the
    bounds from the place aggregate, both of which are written first, so the
    history itself is read once per aggregate and not once per result.
    """
    by_region = settle(
        with_month(df, roles).groupBy(roles.month, roles.region).agg(
            F.count(F.lit(1)).alias("count"),
            *[F.avg(nan_to_null(name)).alias(name) for name in roles.measures],
        ),
        "month-region",
    )
    by_place = settle(
        df.groupBy(*roles.place).agg(F.count(F.lit(1)).alias(roles.frequency)), "places"
    )
    months = by_region.groupBy(roles.month).agg(
        F.sum("count").alias("count"), F.sum(row_bytes(by_region)).alias("size")
    ).collect()  # 13 rows at most
    complete = S.all_of([present(by_place, name) for name in roles.place])
    places = by_place.select(
        "*", row_bytes(by_place).alias("size"), complete.alias("complete")
    )
    facts = bounding_box(places, roles, [
        F.count_if("complete").alias("places"),
        F.coalesce(F.sum(F.when(F.col("complete"), F.col("size"))), F.lit(0)).alias("size"),
    ]).first()
    monthly = df.sparkSession.createDataFrame(
        [(m[roles.month], m["count"]) for m in months if m[roles.month] is not None],
        f"`{roles.month}` int, count bigint",
    )
    known = F.col(roles.month).isNotNull() & F.col(roles.region).isNotNull()
    return Profile(
        rows=sum(m["count"] for m in months),
        shares=_share(monthly),
        stats=by_region.filter(known).drop("count"),
        stats_size=sum(m["size"] for m in months),
        places=hotspot_rank(by_place.filter(complete), roles),
        places_size=facts["size"],
        place_count=facts["places"],
        bounds=facts,
    )


def history_report(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row per month: its share, with the totals of the whole history."""
    by_month = settle(
        with_month(df, roles).groupBy(roles.month).agg(F.count(F.lit(1)).alias("count")),
        "by-month",
    )
    by_place = settle(
        df.groupBy(*roles.place).agg(F.count(F.lit(1)).alias(roles.frequency)), "places"
    )
    known = drop_missing(by_place, roles.place).agg(F.count(F.lit(1)))
    box = bounding_box(by_place, roles)
    packed = box.select(F.struct(*box.columns)).scalar()
    shares = _share(by_month.filter(F.col(roles.month).isNotNull()))
    return shares.select(
        roles.month,
        (F.col("share") * F.lit(100.0)).alias("percent"),
        by_month.agg(F.sum("count")).scalar().alias("rows"),
        known.scalar().alias("places"),
        packed.alias("box"),
    ).select(roles.month, "percent", "rows", "places", "box.*")

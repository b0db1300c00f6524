"""Expand a profile into a table of possible occurrences for one year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from georisk.functions import noise as N, scalars as S
from georisk.operators.lookup import lookup
from georisk.operators.profile import Profile, hotspot_pool
from georisk.roles import DEFAULT_ROLES, Roles

# Scenario size, rest month, place jitter, spread of the noise.
TOTAL_LOW, TOTAL_HIGH = 45_000, 60_000
REST_MONTH = 8
HOTSPOT_SHARE = 0.5
JITTER = 0.5
SPREAD_DRY_DAYS = 5.0
SPREAD_PRECIP = 10.0
SPREAD_FRP = 20.0

# Ranges used where a month and region has no history.
DRY_SEASON = {"dry_days": (15, 60), "precip": (0, 5), "frp": (30, 150)}
WET_SEASON = {"dry_days": (0, 20), "precip": (5, 100), "frp": (10, 80)}

ROW_ID = "row_id"


def scenario_total(spark: SparkSession, seed: int) -> int:
    """A size in the default range, fixed by the seed."""
    draw = N.whole(N.uniform(N.digest(F.lit(0), "total", seed), 0), TOTAL_LOW, TOTAL_HIGH + 1)
    return spark.range(1).select(draw.alias("total")).first()["total"]


def month_quota(shares: DataFrame, total: int, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows per calendar month, always 12 of them.

    A month the history lacks gets one twelfth of the total, and the rest, which
    can be negative then, goes to August.
    """
    months = shares.sparkSession.range(1, 13).select(F.col("id").cast("int").alias(roles.month))
    share = F.coalesce(F.col("share"), F.lit(1.0) / F.lit(12.0))
    quotas = months.join(F.broadcast(shares.select(roles.month, "share")), roles.month, "left")
    quotas = quotas.select(roles.month, F.floor(F.lit(total) * share).alias("quota"))
    rest = F.lit(total) - quotas.agg(F.sum("quota")).scalar()
    extra = F.when(F.col(roles.month) == REST_MONTH, rest).otherwise(F.lit(0))
    return quotas.withColumn("quota", F.col("quota") + extra)


def scenario_rows(
    quotas: DataFrame, year: int, seed: int, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """One row per quota unit, with a row id, a month and a date in the month.

    The twelve quotas turn into thresholds on the id of a distributed range, so
    rows are made in parallel, without a join and without growing an array.
    """
    limits, upper = [], 0
    for month, quota in sorted(quotas.select(roles.month, "quota").collect()):  # 12 rows
        upper += max(quota, 0)
        limits.append((month, upper))
    rows = quotas.sparkSession.range(upper).withColumnRenamed("id", ROW_ID)
    month: Column = F.lit(None).cast("int")
    for number, limit in reversed(limits):
        month = F.when(F.col(ROW_ID) < limit, F.lit(number)).otherwise(month)
    dated = rows.withColumn(roles.month, month)
    first = F.make_date(F.lit(year), F.col(roles.month), F.lit(1))
    u = N.uniform(N.digest(ROW_ID, "place", seed), 0)
    day = F.lit(1) + F.floor(u * S.days_in_month(first)).cast("int")
    return dated.withColumn(roles.date, F.make_date(F.lit(year), F.col(roles.month), day))


def scenario_places(
    rows: DataFrame, profile: Profile, seed: int, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Give each row a place: a hotspot as it is, or any place moved a little.

    The place is picked by its rank, so this is an equi-join on evenly spread
    numbers. Moved places are kept inside the bounds of the history.
    """
    if profile.place_count == 0:
        raise ValueError("the history holds no place")
    drawn = rows.withColumns({
        "__place": N.digest(ROW_ID, "place", seed), "__move": N.digest(ROW_ID, "move", seed),
    })
    place, move, hot = F.col("__place"), F.col("__move"), F.col("__at_hotspot")
    drawn = drawn.withColumn("__at_hotspot", N.uniform(place, 1) < HOTSPOT_SHARE)
    pool = F.when(hot, hotspot_pool(profile.place_count)).otherwise(profile.place_count)
    picked = drawn.withColumn("rank", F.floor(N.uniform(place, 2) * pool).cast("long"))
    places = profile.places.select("rank", *roles.place)
    placed = lookup(picked, places, ["rank"], "inner", size=profile.places_size)
    box = profile.bounds

    def shift(slot: int) -> Column:
        return N.between(N.uniform(move, slot), -JITTER, JITTER)

    def final(name: str, moved: str, low: float, high: float) -> Column:
        inside = S.clip(moved, low, high)
        return S.round_half_even(F.when(hot, F.col(name)).otherwise(inside), 6)

    shifted = placed.withColumns({
        "__lat": F.col(roles.lat) + shift(0), "__lon": F.col(roles.lon) + shift(1),
    })
    return shifted.withColumns({
        roles.lat: final(roles.lat, "__lat", box["lat_min"], box["lat_max"]),
        roles.lon: final(roles.lon, "__lon", box["lon_min"], box["lon_max"]),
    }).drop("rank", "__place", "__move", "__at_hotspot", "__lat", "__lon")


def scenario_measures(
    rows: DataFrame, profile: Profile, seed: int, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Measures around the mean of the month and region, or from fixed ranges."""
    means = profile.stats.select(
        roles.month, roles.region,
        *[F.col(name).alias(f"__{name}") for name in (roles.dry_days, roles.precip, roles.frp)],
        F.lit(True).alias("__known"),
    )
    joined = lookup(rows, means, [roles.month, roles.region], size=profile.stats_size)
    known = F.col("__known").isNotNull()
    drawn = joined.withColumns({
        "__a": F.when(known, N.digest(ROW_ID, "noise-a", seed)),
        "__b": F.when(known, N.digest(ROW_ID, "noise-b", seed)),
        "__range": F.when(~known, N.digest(ROW_ID, "range", seed)),
    })
    first, second, plain = F.col("__a"), F.col("__b"), F.col("__range")
    dry = S.dry_season(roles.month)

    def around(name: str, bell: Column, spread: float) -> Column:
        return F.col(f"__{name}") + bell * F.lit(spread)

    def ranged(part: str, pick, slot: int) -> Column:
        u = N.uniform(plain, slot)
        return F.when(dry, pick(u, *DRY_SEASON[part])).otherwise(pick(u, *WET_SEASON[part]))

    bells = [
        N.normal(N.uniform(first, 0), N.uniform(first, 1)),
        N.normal(N.uniform(first, 2), N.uniform(first, 3)),
        N.normal(N.uniform(second, 0), N.uniform(second, 1)),
    ]
    dry_days = around(roles.dry_days, bells[0], SPREAD_DRY_DAYS).cast("int")
    precip = S.floor_zero(around(roles.precip, bells[1], SPREAD_PRECIP))
    frp = S.floor_zero(around(roles.frp, bells[2], SPREAD_FRP))
    measured = drawn.withColumns({
        roles.dry_days: F.when(known, S.floor_zero(dry_days)).otherwise(
            ranged("dry_days", N.whole, 0)
        ),
        roles.precip: S.round_half_even(
            F.when(known, precip).otherwise(ranged("precip", N.between, 1)), 2
        ),
        roles.frp: S.round_half_even(
            F.when(known, frp).otherwise(ranged("frp", N.between, 2)), 2
        ),
    })
    return measured.select(
        ROW_ID, roles.month, roles.date, *roles.place, roles.dry_days, roles.precip, roles.frp
    )


def expand_scenario(
    profile: Profile,
    year: int = 2026,
    total: int | None = None,
    seed: int = 4224,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """The whole scenario table. Sort it where it is written, not here."""
    if total is None:
        total = scenario_total(profile.shares.sparkSession, seed)
    quotas = month_quota(profile.shares, total, roles)
    rows = scenario_rows(quotas, year, seed, roles)
    return scenario_measures(scenario_places(rows, profile, seed, roles), profile, seed, roles)

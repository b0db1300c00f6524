"""Occurrence-shaped tables derived from orders, customer, nation and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from georisk.functions.scalars import round_half_even
from georisk.operators.cleaning import clean, prepare_occurrences
from georisk.roles import Roles

ROLES = Roles(
    time="event_ts", date="event_date", region="region", locality="locality",
    lat="lat", lon="lon", dry_days="dry_days", precip="precip", frp="frp", risk="risk",
    year="year", month="month", day_of_year="day_of_year", month_flag="month_",
    encoded="_code", prediction="predicted", cluster="cluster", frequency="frequency",
    unused=("satellite", "country", "biome"), source="source_file",
)


# Declared, so that no job reads file footers just to learn the columns.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw occurrences with sentinels and nulls, and the three unused columns."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    key, missing = F.col("o_orderkey"), F.lit(-999.0)

    def part(factor: int, modulus: int, scale: float):
        return (key * factor % modulus).cast("double") / F.lit(scale)

    return orders.join(customer, "o_custkey").join(nation, "c_nationkey").select(
        key.alias("occ_id"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("n_name").alias("region"),
        F.col("c_name").alias("locality"),
        F.when(key % 53 == 0, missing)
        .when(key % 59 != 0, (key % 60).cast("double")).alias("dry_days"),
        F.when(key % 61 == 0, missing).otherwise(part(7, 1000, 10.0)).alias("precip"),
        F.when(key % 67 == 0, missing).when(key % 71 != 0, part(37, 101, 100.0)).alias("risk"),
        F.when(key % 73 == 0, missing)
        .otherwise(F.col("o_totalprice") / F.lit(1000.0)).alias("frp"),
        (F.lit(-24.0) + (F.col("o_custkey") % 220).cast("double") / F.lit(10.0)).alias("lat"),
        (F.lit(-60.0) + (F.col("o_custkey") * 3 % 190).cast("double") / F.lit(10.0)).alias("lon"),
        F.col("o_orderstatus").alias("satellite"),
        F.lit("country").alias("country"),
        F.lit("biome").alias("biome"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(occurrences(spark, sf_dir), ROLES)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and formatted occurrences; risk in percent."""
    return prepare_occurrences(occurrences(spark, sf_dir), ROLES)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with a year and a made-up but repeatable prediction."""
    shift = (F.col("occ_id") * 13 % 41 - 20).cast("double")
    inside = F.least(F.greatest(F.col("risk") + shift, F.lit(0.0)), F.lit(100.0))
    predicted = round_half_even(inside).cast("int")
    return history(spark, sf_dir).withColumns({
        "year": F.year("event_date"), "predicted": predicted,
    })


def january(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of one month only, from the event stream table."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("event_date"),
        F.col("event_type").alias("region"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("locality"),
        (key % 30).cast("double").alias("dry_days"),
        (key % 40).cast("double").alias("precip"),
        F.col("value").cast("double").alias("frp"),
        (key % 101).cast("double").alias("risk"),
        (F.lit(-24.0) + (F.col("user_id") % 200).cast("double") / F.lit(10.0)).alias("lat"),
        (F.lit(-60.0) + (F.col("user_id") % 150).cast("double") / F.lit(10.0)).alias("lon"),
    )

"""Scans of forecast files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from georisk.functions.scalars import drop_null_tokens
from georisk.operators.cleaning import repair_forecast_text
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.sources.occurrences import CSV_OPTIONS


def forecast_schema(roles: Roles = DEFAULT_ROLES) -> T.StructType:
    types = {
        roles.date: T.DateType(),
        roles.region: T.StringType(),
        roles.locality: T.StringType(),
        roles.risk: T.IntegerType(),
        roles.dry_days: T.IntegerType(),
    }
    return T.StructType([
        T.StructField(name, types.get(name, T.DoubleType())) for name in roles.forecast
    ])


def scan_forecast(spark: SparkSession, path: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """A forecast this package wrote; a line that does not fit fails the read."""
    reader = spark.read.options(**CSV_OPTIONS, mode="FAILFAST", dateFormat="yyyy-MM-dd")
    return reader.schema(forecast_schema(roles)).csv(path)


def scan_forecast_text(spark: SparkSession, path: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """A forecast of doubtful quality, all text; blank lines are skipped."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in roles.forecast])
    raw = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return raw.select(*[drop_null_tokens(name).alias(name) for name in roles.forecast])


def load_forecast_text(spark: SparkSession, path: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return repair_forecast_text(scan_forecast_text(spark, path, roles), roles)

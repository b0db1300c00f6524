"""Filters, guards and counts that make occurrences valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from georisk.functions import scalars as S
from georisk.roles import DEFAULT_ROLES, Roles

MISSING = -999.0  # fixed value: stands for "not measured" in the input files


def present(df: DataFrame, name: str) -> Column:
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return S.present(name, floating)


def drop_sentinels(df: DataFrame, columns: Sequence[str], missing: float = MISSING) -> DataFrame:
    """Drop rows holding the sentinel in any column; null rows stay."""
    return df.filter(S.all_of([~F.col(c).eqNullSafe(F.lit(missing)) for c in columns]))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with null or NaN in any column.

    Same rows as ``na.drop``, but spelt as ``IS NOT NULL`` so the scan can skip.
    """
    return df.filter(S.all_of([present(df, c) for c in columns]))


def clean(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return drop_missing(drop_sentinels(df, roles.measures), roles.measures)


def drop_unlocated(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return drop_missing(df, [roles.lat, roles.lon, roles.date])


def drop_repeated_header(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Drop data lines that repeat the header; a missing date is no header."""
    return df.filter(~S.strip(roles.date).eqNullSafe(F.lit(roles.date)))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = missing_columns(df, columns)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Names in ``wanted`` that the table lacks, in their given order."""
    have = set(df.columns)
    return [name for name in wanted if name not in have]


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def time_column(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> str:
    """The time column if there is one, else the date column."""
    for name in (roles.time, roles.date):
        if name in df.columns:
            return name
    raise ValueError(f"neither {roles.time} nor {roles.date} is a column")


def as_timestamp(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return S.parse_time(name)
    return F.col(name).cast("timestamp_ntz")


def require_valid_time(df: DataFrame, name: str) -> DataFrame:
    """Fail while running if any value is null after parsing.

    The check is a filter, so column pruning cannot remove it.
    """
    message = F.lit(f"column {name} holds invalid dates")
    ok = F.when(as_timestamp(df, name).isNull(), F.raise_error(message).cast("boolean"))
    return df.filter(ok.otherwise(F.lit(True)))


def any_invalid_time(df: DataFrame, name: str) -> DataFrame:
    bad = F.coalesce(F.bool_or(as_timestamp(df, name).isNull()), F.lit(False))
    return df.agg(bad.alias("any_invalid"))


def clean_counts(df: DataFrame, valid: Column) -> DataFrame:
    """Rows before and after a validity test, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(valid).alias("rows_after"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("rows_removed"),
    )


def rescale_risk(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.withColumn(roles.risk, F.col(roles.risk) * F.lit(100.0))


def drop_unused(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Drop columns that every occurrence file must have and nobody reads."""
    return require_columns(df, roles.unused).drop(*roles.unused)


def format_occurrences(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Typed time and date, risk in percent, unused columns gone."""
    typed = drop_unused(df, roles)
    typed = typed.withColumn(roles.time, as_timestamp(typed, roles.time))
    return rescale_risk(typed.withColumn(roles.date, F.to_date(roles.time)), roles)


def prepare_occurrences(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return format_occurrences(clean(df, roles), roles)


def union_years(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, matched by column name, absent columns null."""
    if not tables:
        raise ValueError("no tables to union")
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table, allowMissingColumns=True)
    return merged


def coerce_text(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Type an all-text forecast; what does not parse becomes null."""
    typed = {
        name: S.parse_number(name) for name in roles.numeric if name in df.columns
    }
    if roles.date in df.columns:
        typed[roles.date] = S.parse_date(roles.date)
    return df.withColumns(typed)


def repair_forecast_text(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Repeated headers gone, values typed, rows without place or date gone."""
    return drop_unlocated(coerce_text(drop_repeated_header(df, roles), roles), roles)


def keep_year(df: DataFrame, time: str, year: int) -> DataFrame:
    """Rows of one year, as a range so that the scan can skip row groups."""
    first = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    after = F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))
    return df.filter((F.col(time) >= first) & (F.col(time) < after))


def year_or_latest(df: DataFrame, year: str, wanted: int) -> DataFrame:
    """Rows of the wanted year, or of the latest one if there is none.

    An unknown year counts as 0. The choice is a scalar subquery, so a table
    partitioned by year reads only the chosen partition.
    """
    known = F.coalesce(F.col(year), F.lit(0))
    chosen = df.agg(
        F.coalesce(F.max(F.when(known == wanted, known)), F.max(known)).alias("chosen")
    )
    return df.filter(known == chosen.scalar())

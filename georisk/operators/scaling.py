"""Standardisation with the population standard deviation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_STATS = "__stats"


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population standard deviation per column."""
    return df.agg(*[
        part
        for name in columns
        for part in (
            F.avg(name).alias(f"{name}_mean"),
            F.stddev_pop(name).alias(f"{name}_std"),
        )
    ])


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1; a constant column becomes 0.

    The statistics are one aggregate read as a scalar subquery, so the second
    pass is a plain projection without shuffle.
    """
    stats = column_stats(df, columns)
    held = df.withColumn(_STATS, stats.select(F.struct(*stats.columns)).scalar())

    def scaled(name: str) -> Column:
        std = F.col(f"{_STATS}.{name}_std")
        centred = F.col(name) - F.col(f"{_STATS}.{name}_mean")
        return centred / F.when(std == 0, F.lit(1.0)).otherwise(std)

    return held.withColumns({name: scaled(name) for name in columns}).drop(_STATS)

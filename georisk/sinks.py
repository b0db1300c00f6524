"""Writers. Every one of them is a distributed Spark write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from georisk.operators.evaluation import metric_chart_feed
from georisk.operators.risk import forecast_output
from georisk.operators.scenario import ROW_ID
from georisk.roles import DEFAULT_ROLES, Roles


def write_merged(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)


def write_forecast(
    df: DataFrame, path: str, roles: Roles = DEFAULT_ROLES, by_month: bool = False
) -> None:
    """The forecast as CSV, sorted by date; the sort is by ranges, not one task.

    The row id breaks ties, so even one crowded day spreads over many ranges.
    """
    if by_month:
        month = F.month(F.to_date(roles.date))
        forecast_output(df, roles).withColumn("month", month).hint("rebalance", "month").write.mode(
            "overwrite"
        ).partitionBy("month").options(header="true", quote='"', escape='"').csv(path)
        return
    ties = [ROW_ID] if ROW_ID in df.columns else list(roles.forecast)
    write_csv(forecast_output(df.orderBy(roles.date, *ties), roles), path)


def write_metrics(scores: DataFrame, folder: str, roles: Roles = DEFAULT_ROLES) -> None:
    """Yearly metric files, one row per year, and the table behind the charts."""
    continuous = scores.select(roles.year, "MAE", "RMSE", "R2", "n").orderBy(roles.year)
    margin = scores.select(roles.year, "accuracy_margin", "n").orderBy(roles.year)
    # Names of the metric files.
    write_csv(continuous.coalesce(1), f"{folder}/metrics_continuas_por_ano.csv")
    write_csv(margin.coalesce(1), f"{folder}/metrics_margem_por_ano.csv")
    metric_chart_feed(scores, roles).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/charts"
    )


def write_feed(df: DataFrame, path: str, year: str = "ano") -> None:
    """A map feed partitioned by year.

    Rebalancing by year keeps a year's rows in few files, and adaptive
    execution splits a year that is too large for one task.
    """
    df.hint("rebalance", year).write.mode("overwrite").partitionBy(year).parquet(path)

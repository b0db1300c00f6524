"""How close predictions come to the truth, per year and on the map."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from georisk.functions import scalars as S
from georisk.operators.cleaning import drop_missing
from georisk.operators.ordering import exact_median
from georisk.operators.risk import share_of_largest
from georisk.operators.sampling import exact_sample
from georisk.roles import DEFAULT_ROLES, Roles

MARGIN = 10.0  # fixed value: a hit is at most this far off


def yearly_scores(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, truth: str | None = None, margin: float = MARGIN
) -> DataFrame:
    """All metrics of all years in one aggregation; rows without a year drop out."""
    known = df.filter(F.col(roles.year).isNotNull())
    return scores_by(known, [roles.year], roles, truth, margin)


def overall_scores(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, truth: str | None = None, margin: float = MARGIN
) -> DataFrame:
    """The same metrics over all rows, as one row."""
    return scores_by(df, [], roles, truth, margin)


def scores_by(
    df: DataFrame, keys: list[str], roles: Roles, truth: str | None, margin: float
) -> DataFrame:
    """Metrics per group of ``keys``.

    R2 is one minus the squared error over the spread of the truth. Without any
    spread it is 1 if there is no error and else 0; a single row gives NaN.
    """
    truth = truth or roles.risk
    y, p = F.col(truth).cast("double"), F.col(roles.prediction).cast("double")
    error = S.absolute_error(y, p)
    sums = df.groupBy(*keys).agg(
        F.avg(error).alias("MAE"),
        F.avg(error * error).alias("__mse"),
        F.var_pop(y).alias("__spread"),
        F.avg((error <= margin).cast("double")).alias("accuracy_margin"),
        F.count(F.lit(1)).alias("n"),
    )
    flat = F.when(F.col("__mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = (
        F.when(F.col("n") < 2, F.lit(float("nan")))
        .when(F.col("__spread") == 0, flat)
        .otherwise(F.lit(1.0) - F.try_divide("__mse", "__spread"))
    )
    return sums.select(
        *keys, "MAE", F.sqrt("__mse").alias("RMSE"), r2.alias("R2"), "n", "accuracy_margin"
    )


def metrics_by_year(df: DataFrame, roles: Roles = DEFAULT_ROLES, **options) -> DataFrame:
    scores = yearly_scores(df, roles, **options)
    return scores.select(roles.year, "MAE", "RMSE", "R2", "n").orderBy(roles.year)


def margin_by_year(df: DataFrame, roles: Roles = DEFAULT_ROLES, **options) -> DataFrame:
    scores = yearly_scores(df, roles, **options)
    return scores.select(roles.year, "accuracy_margin", "n").orderBy(roles.year)


def metric_chart_feed(scores: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row per year and charted metric, from the yearly scores."""
    charted = ["MAE", "RMSE", "R2", "accuracy_margin"]
    return scores.unpivot([roles.year], charted, "metric", "value")


def with_outcome(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, margin: float = MARGIN
) -> DataFrame:
    return df.withColumn(
        "result_margem", S.outcome(F.col(roles.risk), F.col(roles.prediction), margin)
    ).withColumn("colour", S.outcome_colour("result_margem"))


def error_map(
    df: DataFrame,
    year: int,
    roles: Roles = DEFAULT_ROLES,
    margin: float = MARGIN,
    sample: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """Points of one year with outcome, colour and popup text.

    ``sample`` limits the map to that many points, drawn by ``key``.
    """
    points = df.filter(F.col(roles.year) == year)
    if sample is not None:
        if key is None:
            raise ValueError("a sampled map needs a row key")
        points = exact_sample(points, sample, key)
    judged = with_outcome(points, roles, margin)
    # Fixed value: layout of the popup text.
    popup = F.concat(
        F.lit("Ano:"), F.col(roles.year).cast("int").cast("string"),
        F.lit("<br>Data:"), F.date_format(roles.date, "yyyy-MM-dd"),
        F.lit("<br>Risco_true:"), F.col(roles.risk).cast("int").cast("string"),
        F.lit(" - Risco_pred:"), F.col(roles.prediction).cast("int").cast("string"),
        F.lit("<br>Resultado:"), F.col("result_margem"),
    )
    return judged.withColumn("popup", popup).select(
        roles.lat, roles.lon, roles.year, roles.date, roles.risk, roles.prediction,
        "result_margem", "colour", "popup",
    )


def map_centre(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Exact median latitude and longitude."""
    return exact_median(df, [roles.lat, roles.lon])


def complete_points(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    columns = [roles.lat, roles.lon, roles.risk, roles.prediction]
    return drop_missing(df.select(*columns), columns)


def error_heat(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Points weighted by their error over the largest error.

    ``df`` is read twice, so pass a written table if its predictions are costly.
    """
    points = complete_points(df, roles).select(
        roles.lat, roles.lon,
        S.absolute_error(roles.risk, roles.prediction).cast("double").alias("erro_abs"),
    )
    return share_of_largest(points, points, "erro_abs", "weight", 0.0)

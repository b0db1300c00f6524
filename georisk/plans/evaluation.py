"""Evaluation: score a history once and write metrics and map feeds from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from georisk.operators.evaluation import (
    complete_points,
    error_heat,
    error_map,
    map_centre,
    overall_scores,
    yearly_scores,
)
from georisk.operators.models import HELD_OUT, ModelBundle, mark_held_out, score_history
from georisk.roles import DEFAULT_ROLES, Roles
from georisk.sinks import write_metrics
from georisk.workspace import settle

MAP_YEAR = 2025  # fixed value: the year the error map shows


def run_evaluation(
    history: DataFrame,
    bundle: ModelBundle,
    folder: str,
    year: int = MAP_YEAR,
    sample: int | None = None,
    key: str | None = None,
    split_key: str | None = None,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Write all evaluation tables; returns the yearly scores.

    Yearly scores cover every row, as published; the table ``holdout`` covers
    only those that training with its default share and seed left out, split by
    ``split_key`` or by the whole row.

    The model runs once: what the four consumers need of the scored rows is
    written before they start, without the features.
    """
    needed = [roles.lat, roles.lon, roles.date, roles.year, roles.risk, roles.prediction]
    needed += [HELD_OUT, *([key] if key is not None else [])]
    marked = mark_held_out(history, roles, split_key)
    needed = dict.fromkeys(needed)  # the key may be one of the other columns
    scored = settle(score_history(marked, bundle, roles).select(*needed), "scored")
    scores = settle(yearly_scores(scored, roles), "scores")
    write_metrics(scores, folder, roles)
    unseen = overall_scores(scored.filter(F.col(HELD_OUT)), roles)
    unseen.write.mode("overwrite").parquet(f"{folder}/holdout")
    points = error_map(scored, year, roles, sample=sample, key=key)
    points.write.mode("overwrite").parquet(f"{folder}/error_map")
    map_centre(points, roles).write.mode("overwrite").parquet(f"{folder}/error_map_centre")
    error_heat(scored, roles).write.mode("overwrite").parquet(f"{folder}/error_heat")
    centre = map_centre(complete_points(scored, roles), roles)
    centre.write.mode("overwrite").parquet(f"{folder}/error_heat_centre")
    return scores

import datetime
import math

import numpy as np
import pytest

from georisk.operators import evaluation as E
from georisk.roles import Roles

ROLES = Roles()


def scored(spark, rows):
    return spark.createDataFrame(rows, "Ano int, RiscoFogo double, Risco_pred int")


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(int(a), float(y), int(p)) for a, y, p in zip(
        rng.integers(2014, 2017, 300), rng.uniform(0, 100, 300), rng.integers(0, 101, 300))]
    got = {r["Ano"]: r for r in E.yearly_scores(scored(spark, rows), ROLES).collect()}
    for year in (2014, 2015, 2016):
        y = np.array([r[1] for r in rows if r[0] == year])
        p = np.array([r[2] for r in rows if r[0] == year])
        row = got[year]
        assert row["n"] == len(y)
        assert math.isclose(row["MAE"], np.abs(y - p).mean())
        assert math.isclose(row["RMSE"], math.sqrt(((y - p) ** 2).mean()))
        assert math.isclose(row["R2"], 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
        assert math.isclose(row["accuracy_margin"], (np.abs(y - p) <= 10).mean())


def test_flat_truth_single_row_and_unknown_year(spark):
    rows = [
        (2014, 29.1, 29), (2014, 29.1, 30),
        (2015, 30.0, 30), (2015, 30.0, 30),
        (2016, 10.0, 10), (None, 1.0, 1),
    ]
    got = E.metrics_by_year(scored(spark, rows), ROLES).collect()
    assert [r["Ano"] for r in got] == [2014, 2015, 2016]
    assert got[0]["R2"] == 0.0 and got[1]["R2"] == 1.0 and math.isnan(got[2]["R2"])


def test_margin_is_inclusive(spark):
    rows = [(2014, 50.0, 60), (2014, 50.0, 61)]
    assert E.margin_by_year(scored(spark, rows), ROLES).first()["accuracy_margin"] == 0.5


def test_error_map_popup(spark):
    df = spark.createDataFrame(
        [(-10.0, -50.0, 2025, datetime.date(2025, 8, 9), 28.999999999999996, 40),
         (-11.0, -51.0, 2024, datetime.date(2024, 8, 9), 10.0, 10)],
        "Latitude double, Longitude double, Ano int, Data date, RiscoFogo double, Risco_pred int",
    )
    rows = E.error_map(df, 2025, ROLES).collect()
    assert [r["popup"] for r in rows] == [
        "Ano:2025<br>Data:2025-08-09<br>Risco_true:28 - Risco_pred:40<br>Resultado:SOBRE"
    ]
    assert rows[0]["colour"] == "orange"
    assert E.error_map(df, 2020, ROLES).isEmpty()
    with pytest.raises(ValueError, match="row key"):
        E.error_map(df, 2025, ROLES, sample=1)


def heat(spark, rows):
    return spark.createDataFrame(rows, "Latitude double, Longitude double, RiscoFogo double, Risco_pred int")


def test_error_heat_weights(spark):
    rows = [(1.0, 1.0, 50.0, 40), (2.0, 2.0, 50.0, 70), (None, 1.0, 0.0, 100), (3.0, 3.0, None, 5)]
    got = sorted((r["erro_abs"], r["weight"]) for r in E.error_heat(heat(spark, rows), ROLES).collect())
    assert got == [(10.0, 0.5), (20.0, 1.0)]


def test_error_heat_without_error(spark):
    got = E.error_heat(heat(spark, [(1.0, 1.0, 50.0, 50)]), ROLES).collect()
    assert [r["weight"] for r in got] == [0.0]

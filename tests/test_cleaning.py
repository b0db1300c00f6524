import datetime

import pytest
from pyspark.sql import functions as F

from georisk.operators import cleaning as C
from georisk.roles import Roles

ROLES = Roles()
NAN = float("nan")
MEASURES = "DiaSemChuva double, Precipitacao double, FRP double, RiscoFogo double"


def measured(spark):
    good = [1.0, 2.0, 3.0, 0.5]
    rows = [good]
    for place in range(4):
        for bad in (-999.0, None, NAN):
            rows.append([bad if i == place else v for i, v in enumerate(good)])
    return spark.createDataFrame([tuple(r) for r in rows], MEASURES)


def test_sentinels_go_nulls_stay(spark):
    df = measured(spark)
    assert df.count() == 13
    assert C.drop_sentinels(df, ROLES.measures).count() == 9
    assert C.drop_missing(df, ROLES.measures).count() == 5
    assert C.clean(df, ROLES).count() == 1


def test_drop_missing_equals_na_drop(spark):
    df = measured(spark)
    expected = df.na.drop(subset=list(ROLES.measures))
    assert C.drop_missing(df, ROLES.measures).exceptAll(expected).isEmpty()


def test_dirty_forecast_text(spark):
    rows = [
        ("2026-01-05", "-10.5", "-50.1", "7"),
        (" Data ", "Latitude", "Longitude", "RiscoFogo"),
        ("Data", "Latitude", "Longitude", "RiscoFogo"),
        ("2026/01/06", " -11 ", "-51", "x"),
        ("no day", "-10", "-50", "1"),
        (None, "-10", "-50", "1"),
        ("2026-01-07", "1,5", "-50", "1"),
        ("2026-01-08", "-10", "", "1"),
    ]
    df = spark.createDataFrame(rows, "Data string, Latitude string, Longitude string, RiscoFogo string")
    assert C.drop_repeated_header(df, ROLES).count() == 6
    fixed = C.repair_forecast_text(df, ROLES).orderBy("Data").collect()
    assert [tuple(r) for r in fixed] == [
        (datetime.date(2026, 1, 5), -10.5, -50.1, 7.0),
        (datetime.date(2026, 1, 6), -11.0, -51.0, None),
    ]


def test_clean_counts(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,)], "x double")
    assert tuple(C.clean_counts(df, C.present(df, "x")).first()) == (3, 1, 2)


def test_invalid_time_fails_even_if_unused(spark):
    df = spark.createDataFrame([("2015-01-01", 1), ("x", 2)], "DataHora string, v int")
    assert C.any_invalid_time(df, "DataHora").first()[0] is True
    with pytest.raises(Exception, match="invalid dates"):
        C.require_valid_time(df, "DataHora").select("v").collect()
    fine = df.filter("v = 1")
    assert C.require_valid_time(fine, "DataHora").count() == 1
    with pytest.raises(ValueError, match="neither"):
        C.time_column(df.drop("DataHora"), ROLES)


def test_any_invalid_time_of_nothing(spark):
    empty = spark.createDataFrame([], "Data string")
    assert C.any_invalid_time(empty, "Data").first()[0] is False


def test_unused_columns_must_exist(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Satelite int, Pais int, Bioma int, x int")
    assert C.drop_unused(df, ROLES).columns == ["x"]
    with pytest.raises(ValueError, match="Pais"):
        C.drop_unused(df.drop("Pais"), ROLES)


def test_union_by_name_fills_null(spark):
    a = spark.createDataFrame([(1, "p")], "x int, y string")
    b = spark.createDataFrame([("q", 2.0)], "y string, z double")
    rows = C.union_years([a, b]).orderBy("y").collect()
    assert [tuple(r) for r in rows] == [(1, "p", None), (None, "q", 2.0)]
    with pytest.raises(ValueError):
        C.union_years([])


def test_year_or_latest(spark):
    df = spark.createDataFrame([(2019, 1), (2021, 2), (2021, 3), (None, 4)], "ano int, v int")
    pick = lambda wanted, rows=df: sorted(r["v"] for r in C.year_or_latest(rows, "ano", wanted).collect())
    assert pick(2019) == [1]
    assert pick(2025) == [2, 3]
    assert pick(2025, df.filter("ano is null")) == [4]
    assert pick(2025, df.filter("v > 9")) == []


def test_keep_year(spark):
    days = [datetime.date(2015, 12, 31), datetime.date(2016, 1, 1), datetime.date(2016, 12, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert sorted(r[0] for r in C.keep_year(df, "d", 2016).collect()) == days[1:3]


def test_missing_columns_and_empty_input(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert C.missing_columns(df, ["b", "a", "c"]) == ["b", "c"]
    assert C.require_rows(df, "input") is df
    with pytest.raises(ValueError, match="empty"):
        C.require_rows(df.filter(F.lit(False)), "input")

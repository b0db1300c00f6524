import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from georisk.functions import noise as N, scalars as S


def one(spark, column, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [row[0] for row in df.select(column).collect()]


def test_round_half_even_equals_numpy(spark):
    values = [0.125, 2.5, 2.675, 28.999999999999996, -0.125, 1e9 + 0.005, 0.5, 1.5]
    for digits in (0, 2, 6):
        got = one(spark, S.round_half_even("x", digits), [(v,) for v in values], "x double")
        assert got == [float(np.round(v, digits)) for v in values]


def test_percent_ceiling(spark):
    got = one(spark, S.percent_ceiling("x"), [(0.0,), (0.281,), (0.29,), (1.0,)], "x double")
    assert got == [0, 29, 29, 100]


def test_clip_keeps_null_and_nan(spark):
    rows = [(-5.0,), (0.5,), (7.0,), (None,), (float("nan"),)]
    got = one(spark, S.clip("x", 0.0, 1.0), rows, "x double")
    assert got[:4] == [0.0, 0.5, 1.0, None]
    assert math.isnan(got[4])


def test_floor_zero(spark):
    assert one(spark, S.floor_zero("x"), [(-2,), (3,), (None,)], "x int") == [0, 3, 0]


@pytest.mark.parametrize("text, expected", [
    ("2015-01-02 03:04:05", datetime.datetime(2015, 1, 2, 3, 4, 5)),
    ("2015/01/02 03:04:05", datetime.datetime(2015, 1, 2, 3, 4, 5)),
    ("2015-01-02T03:04:05.25", datetime.datetime(2015, 1, 2, 3, 4, 5, 250000)),
    ("2015/01/02", datetime.datetime(2015, 1, 2)),
    (" 2015-01-02 ", datetime.datetime(2015, 1, 2)),
    ("2015-02-30", None),
    ("not a day", None),
    ("", None),
    (None, None),
])
def test_parse_time(spark, text, expected):
    assert one(spark, S.parse_time("t"), [(text,)], "t string") == [expected]


def test_parse_number(spark):
    rows = [("1.5",), (" -2 ",), ("1e3",), ("1d",), ("12,5",), ("NaN",), ("",), (None,), ("0x1",)]
    got = one(spark, S.parse_number("t"), rows, "t string")
    assert got == [1.5, -2.0, 1000.0] + [None] * 6


def test_null_tokens(spark):
    rows = [(t,) for t in ("NA", "null", "None", "", "n/a", "value", "nano", None)]
    got = one(spark, S.drop_null_tokens("t"), rows, "t string")
    assert got == [None] * 5 + ["value", "nano", None]


def test_outcome_and_colour(spark):
    df = spark.createDataFrame(
        [(50.0, 60), (50.0, 40), (50.0, 61), (50.0, 39)], "y double, p int"
    ).withColumn("r", S.outcome("y", "p")).withColumn("c", S.outcome_colour("r"))
    assert [(r["r"], r["c"]) for r in df.collect()] == [
        ("ACERTO", "green"), ("ACERTO", "green"), ("SOBRE", "orange"), ("SUB", "red"),
    ]
    other = spark.createDataFrame([("?",), (None,)], "r string")
    assert [r[0] for r in other.select(S.outcome_colour("r")).collect()] == ["gray", "gray"]


def test_weekday_and_month_length(spark):
    rows = [(datetime.date(2026, 12, 1),), (datetime.date(2024, 2, 10),)]
    df = spark.createDataFrame(rows, "d date")
    got = df.select(F.weekday("d"), S.days_in_month("d")).collect()
    assert [tuple(r) for r in got] == [(1, 31), (5, 29)]


def test_noise_moments_and_ranges(spark):
    draws = spark.range(20000).select(
        N.uniform(N.digest("id", "a", 1), 0).alias("u"),
        N.normal(N.uniform(N.digest("id", "a", 1), 1), N.uniform(N.digest("id", "a", 1), 2)).alias("z"),
        N.whole(N.uniform(N.digest("id", "b", 1), 3), 15, 60).alias("w"),
    ).agg(
        F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev_pop("z"), F.min("w"), F.max("w")
    ).first()
    low, high, mean, z_mean, z_std, w_low, w_high = draws
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.01
    assert abs(z_mean) < 0.03 and abs(z_std - 1) < 0.03
    assert (w_low, w_high) == (15, 59)


def test_noise_does_not_depend_on_partitions(spark):
    value = N.uniform(N.digest("id", "x", 7), 2)
    few = spark.range(0, 1000, 1, 1).select("id", value.alias("u"))
    many = spark.range(0, 1000, 1, 13).select("id", value.alias("u"))
    assert few.exceptAll(many).isEmpty()
    with pytest.raises(ValueError):
        N.uniform(N.digest("id", "x", 7), 4)

import datetime

import pytest
from pyspark.sql import functions as F

from georisk.operators import profile as P, risk as R, scenario as G
from georisk.roles import Roles

ROLES = Roles()
SCHEMA = (
    "Data date, Estado string, Municipio string, Latitude double, Longitude double,"
    " DiaSemChuva double, Precipitacao double, FRP double, RiscoFogo double"
)


def history(spark, months=range(1, 13), places=12, rows=600):
    months = list(months)
    data = [
        (
            datetime.date(2020, months[i % len(months)], 1 + i % 28),
            "ABC"[i % places % 3], f"town {i % places}",
            -10.0 - i % places, -50.0 + i % places / 10,
            float(i % 40), float(i % 90), float(i % 70), float(i % 101),
        )
        for i in range(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def quotas(spark, months, total, rows=600):
    shares = P.month_share(history(spark, months, rows=rows), ROLES)
    return {r["Mes"]: r["quota"] for r in G.month_quota(shares, total, ROLES).collect()}


def test_quota_sums_to_total_when_all_months_are_known(spark):
    got = quotas(spark, range(1, 13), 1234)
    assert sum(got.values()) == 1234 and len(got) == 12
    assert got[1] == 102 and got[8] == 102 + 1234 - 12 * 102


def test_january_only_history_overshoots_and_august_is_negative(spark):
    got = quotas(spark, [1], 1200)
    assert got[1] == 1200 and got[2] == 100 and got[8] == -1000 + 100 - 100
    rows = G.scenario_rows(
        G.month_quota(P.month_share(history(spark, [1]), ROLES), 1200, ROLES), 2026, 1, ROLES
    )
    by_month = {r["Mes"]: r["count"] for r in rows.groupBy("Mes").count().collect()}
    assert rows.count() == 1200 + 10 * 100 and 8 not in by_month


def test_scenario_invariants(spark):
    known = P.profile_history(history(spark), ROLES)
    rows = G.expand_scenario(known, 2026, 3000, 7, ROLES).cache()
    assert rows.count() == 3000
    assert rows.filter(F.year("Data") != 2026).isEmpty()
    assert rows.filter(F.month("Data") != F.col("Mes")).isEmpty()
    assert rows.filter("DiaSemChuva < 0 or Precipitacao < 0 or FRP < 0").isEmpty()
    assert rows.filter("Latitude < -21 or Latitude > -10 or Longitude < -50 or Longitude > -48.9").isEmpty()
    exact = rows.join(known.places, ["Latitude", "Longitude", "Estado", "Municipio"], "left_semi")
    assert 0.4 < exact.count() / 3000 < 0.75
    assert rows.select("row_id").distinct().count() == 3000
    rows.unpersist()


def test_scenario_does_not_depend_on_partitions(spark):
    df = history(spark)
    first = G.expand_scenario(P.profile_history(df.repartition(7), ROLES), 2026, 500, 7, ROLES)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        second = G.expand_scenario(P.profile_history(df.coalesce(1), ROLES), 2026, 500, 7, ROLES)
        assert first.exceptAll(second).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    other = G.expand_scenario(P.profile_history(df, ROLES), 2026, 500, 8, ROLES)
    assert not first.exceptAll(other).isEmpty()


def test_default_ranges_without_history(spark):
    known = P.profile_history(history(spark, [1]), ROLES)
    rows = G.expand_scenario(known, 2026, 2400, 3, ROLES)
    bounds = {
        r["dry"]: r for r in rows.filter("Mes <> 1").groupBy(F.col("Mes").between(5, 10).alias("dry")).agg(
            F.min("DiaSemChuva").alias("d0"), F.max("DiaSemChuva").alias("d1"),
            F.min("Precipitacao").alias("p0"), F.max("Precipitacao").alias("p1"),
            F.min("FRP").alias("f0"), F.max("FRP").alias("f1"),
        ).collect()
    }
    dry, wet = bounds[True], bounds[False]
    assert dry["d0"] >= 15 and dry["d1"] <= 59 and wet["d0"] >= 0 and wet["d1"] <= 19
    assert dry["p0"] >= 0 and dry["p1"] <= 5 and wet["p0"] >= 5 and wet["p1"] <= 100
    assert dry["f0"] >= 30 and dry["f1"] <= 150 and wet["f0"] >= 10 and wet["f1"] <= 80


@pytest.mark.parametrize("places, pool", [(1, 1), (2, 1), (3, 1), (9, 3)])
def test_few_places(spark, places, pool):
    known = P.profile_history(history(spark, places=places, rows=90), ROLES)
    assert known.place_count == places and P.hotspot_pool(places) == pool
    assert P.top_hotspots(known.places, places).count() == pool
    assert G.expand_scenario(known, 2026, 50, 1, ROLES).count() == 50


def test_no_place_is_an_error(spark):
    known = P.profile_history(history(spark).filter(F.lit(False)), ROLES)
    assert known.place_count == 0 and known.rows == 0
    with pytest.raises(ValueError, match="no place"):
        G.expand_scenario(known, 2026, 10, 1, ROLES)


def test_rank_ties_follow_the_place(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0, "b", "y", 5), (1.0, 1.0, "a", "x", 5), (3.0, 1.0, "c", "z", 9)],
        "Latitude double, Longitude double, Estado string, Municipio string, Frequencia bigint",
    )
    got = {r["Municipio"]: r["rank"] for r in P.hotspot_rank(df, ROLES).collect()}
    assert got == {"z": 0, "x": 1, "y": 2}


def test_default_total_is_in_range(spark):
    totals = [G.scenario_total(spark, seed) for seed in range(5)]
    assert all(45000 <= t <= 60000 for t in totals) and len(set(totals)) > 1
    assert G.scenario_total(spark, 3) == totals[3]


def test_profile_agrees_with_single_operators(spark):
    df = history(spark).union(spark.createDataFrame(
        [(None, "A", None, -30.0, -70.0, 1.0, 1.0, 1.0, 1.0),
         (datetime.date(2020, 3, 1), None, "t", float("nan"), -40.0, 1.0, 1.0, 1.0, 1.0)], SCHEMA))
    known = P.profile_history(df, ROLES)
    assert known.rows == 602
    assert known.shares.exceptAll(P.month_share(df, ROLES)).isEmpty()
    assert known.stats.exceptAll(P.month_region_stats(df, ROLES).select(known.stats.columns)).isEmpty()
    places = P.coord_frequency(df, ROLES)
    assert known.places.drop("rank").select(places.columns).exceptAll(places).isEmpty()
    box = P.bounding_box(df, ROLES).first()
    assert [known.bounds[c] for c in box.asDict()] == list(box)
    assert box["lat_min"] == -30.0 and box["lat_max"] == -10.0


def test_distinct_places_count_pairs_with_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, 2.0), (None, None)], "Latitude double, Longitude double")
    assert P.distinct_places(df, ROLES).first()[0] == 3


def test_edge_days_with_few_days(spark):
    days = [datetime.datetime(2020, 1, d, 5) for d in (3, 1, 3, 2)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "t timestamp_ntz")
    rows = P.edge_days(df, "t").collect()
    assert len(rows) == 6 and {r["distinct_days"] for r in rows} == {3}


def clusters(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Cluster double")


@pytest.mark.parametrize("values, expected", [
    ([0.0, 5.0, 10.0], [0, 50, 100]),
    ([0.0, 0.0], [50, 50]),
    ([-2.0, -1.0], [50, 50]),
    ([-1.0, 4.0], [0, 100]),
    ([3.0, 7.0], [43, 100]),
])
def test_risk_from_scores(spark, values, expected):
    got = R.score_to_risk(clusters(spark, values), None, ROLES)
    assert sorted(r["RiscoFogo"] for r in got.collect()) == expected


def test_risk_from_clusters_has_a_default(spark):
    table = spark.createDataFrame([(1, 0.281), (2, None), (3, float("nan"))], "id int, mean double")
    got = R.score_to_risk(clusters(spark, [1.0, 2.0, 3.0, 9.0]), table, ROLES)
    assert {r["Cluster"]: r["RiscoFogo"] for r in got.collect()} == {1.0: 29, 2.0: 50, 3.0: 50, 9.0: 50}


def test_adjustment_uses_the_integer_risk(spark):
    df = spark.createDataFrame([(50, 10, 100.0, 40.0)], "RiscoFogo int, DiaSemChuva int, Precipitacao double, FRP double")
    row = R.adjust_measures(df, ROLES).first()
    assert (row["DiaSemChuva"], row["Precipitacao"], row["FRP"]) == (11, 90.0, 70.0)


def test_cluster_counts_skip_null(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (None,)], "Cluster int")
    assert [tuple(r) for r in R.cluster_counts(df, ROLES).collect()] == [(1, 1), (2, 2)]

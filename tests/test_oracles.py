"""Every query against its SQL on DuckDB, whole results."""

import pytest

import __spark_entry__ as entry
from driver_queries.oracles import ORACLES
from driver_queries.queries import QUERIES as OWN_QUERIES
from georisk.operators import lookup
from tests.oracle_check import compare, connect

# The library's own queries; parts that may be absent have tests of their own.
SQL = ORACLES
QUERIES = dict(OWN_QUERIES)


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    without = {"forest_scores", "forecast_scores", "cluster_forecast", "kmeans_sweep", "best_k"}
    assert set(QUERIES) - set(SQL) == without


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert compare(spark, db, QUERIES[name], SQL[name], sf_dir) is None


WITH_LOOKUPS = [
    "label_encode", "label_decode", "feature_table", "scenario_coords", "scenario_measures",
    "scenario_defaults", "risk_from_clusters", "yearly_map_feed", "forecast_output",
]


@pytest.mark.parametrize("name", WITH_LOOKUPS)
def test_same_result_when_nothing_may_be_broadcast(spark, db, sf_dir, name, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    assert compare(spark, db, QUERIES[name], SQL[name], sf_dir) is None


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["year", "MAE", "RMSE", "R2", "n"]
    assert result.count() > 0

"""Hot keys, global positions, exact medians and samples, and plan shapes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from georisk.operators.cleaning import clean
from georisk.operators.lookup import hot_key_join, lookup, table_bytes
from georisk.operators import ordering
from georisk.operators.ordering import (
    exact_median,
    global_rank,
    group_at,
    medians_within,
    number_rows,
)
from georisk.operators.sampling import exact_sample, split_by_key
from georisk.roles import Roles
from georisk.workspace import lay_out, new_path, settle


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a tenth without a key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 != 0, F.concat(F.lit("k"), n % 4000))
    return spark.range(20000).select(n.alias("row"), key.alias("k"))


@pytest.fixture(scope="module")
def keyed(spark):
    table = spark.range(3000).select(
        F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v")
    )
    return settle(table.union(spark.createDataFrame([("hot", -1)], "k string, v bigint")))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_plain_join(spark, skewed, keyed, how):
    expected = skewed.join(keyed, ["k"], how)
    got = hot_key_join(skewed, keyed, ["k"], how)
    assert got.count() == expected.count()
    assert got.exceptAll(expected).isEmpty()


def test_hot_rows_are_not_shuffled(spark, skewed, keyed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(hot_key_join(skewed, keyed, ["k"], "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    hot_branch = text.split("Union")[1].split("SortMergeJoin")[0]
    assert hot_branch.count("BroadcastHashJoin") >= 2


def test_lookup_chooses_by_size(spark, skewed, keyed):
    size = table_bytes(keyed)
    assert size > 3000 * 16
    small = lookup(skewed, keyed, ["k"], size=size)
    large = lookup(skewed, keyed, ["k"], size=size, broadcast_bytes=size - 1)
    assert "Union" not in plan(small) and "Union" in plan(large)
    assert small.exceptAll(large).isEmpty()


def test_lookup_on_two_keys_with_nulls(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (2, "b")], "m int, r string")
    table = spark.createDataFrame([(1, "a", 10)], "m int, r string, v int")
    for bound in (0, 1 << 20):
        got = lookup(rows, table, ["m", "r"], broadcast_bytes=bound).collect()
        assert sorted((r["v"] or 0) for r in got) == [0, 0, 0, 10]


def test_global_rank_over_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x"))
        ranked = global_rank(df, [F.col("x").desc()], "rank")
        assert ranked.filter(F.col("rank") != 4999 - F.col("x")).isEmpty()
        assert ranked.count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("size", [1, 2, 3, 1000, 1001])
def test_exact_median_equals_pandas(spark, size):
    rng = np.random.default_rng(size)
    frame = pd.DataFrame({"a": rng.normal(size=size), "b": rng.integers(0, 4, size).astype(float)})
    df = spark.createDataFrame(frame)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = exact_median(df, ["a", "b"]).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (got["a"], got["b"]) == (frame["a"].median(), frame["b"].median())


@pytest.mark.parametrize("ends", [(5.0, 6.0), (-9.0, -8.0), (0.4, 0.6), (float("-inf"), float("inf"))])
def test_median_outside_its_bracket_is_not_guessed(spark, ends):
    df = spark.createDataFrame([(v,) for v in (0.1, 0.5, 0.5, 0.5, 7.0)], "a double")
    expected = 0.5 if ends[0] <= 0.5 <= ends[1] else None
    assert medians_within(df, {"a": 5}, {"a": ends}) == {"a": expected}


def test_exact_median_recovers_from_a_wrong_bracket(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MARGIN", -0.4)  # asks for the ends in the wrong order
    df = spark.range(1001).select(F.col("id").cast("double").alias("a"))
    assert exact_median(df, ["a"]).first()["a"] == 500.0


def test_exact_median_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (4.0, None)], "a double, b double")
    assert tuple(exact_median(df, ["a", "b"]).first()) == (2.5, None)


@pytest.mark.parametrize("size", [0, 1, 777, 4999, 5000, 9000])
def test_exact_sample_size(spark, size):
    df = spark.range(5000)
    got = exact_sample(df, size, "id")
    assert got.count() == min(size, 5000)
    assert got.distinct().count() == min(size, 5000)
    again = exact_sample(df.repartition(3), size, "id")
    assert again.exceptAll(got).isEmpty()


def test_exact_sample_with_copies_of_one_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"))
    for size in (1, 500, 1500, 2500):
        assert exact_sample(df, size, "id").count() == size


def test_exact_sample_keeps_rows_without_a_key(spark):
    df = spark.range(300).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"))
    assert exact_sample(df, 299, "id").count() == 299
    assert exact_sample(df, 40, "id").count() == 40


def test_number_rows(spark):
    df = spark.range(0, 1000, 1, 7)
    places = [r["n"] for r in number_rows(df, "n").select("n").collect()]
    assert sorted(places) == list(range(1000))


@pytest.mark.parametrize("position, group, before", [(0, 0, 0), (4, 0, 0), (5, 1, 5), (499, 99, 495)])
def test_group_at(spark, position, group, before):
    counts = spark.range(100).select("id", F.lit(5).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = group_at(counts, [F.col("id")], "n", position)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (row["id"], row["before"]) == (group, before)


def test_split_is_a_partition_of_the_rows(spark):
    df = spark.range(10000)
    train, test = split_by_key(df, "id")
    assert train.count() + test.count() == 10000
    assert abs(train.count() - 8000) < 200
    assert train.intersect(test).isEmpty()
    everything, nothing = split_by_key(df, "id", 1.0)
    assert everything.count() == 10000 and nothing.isEmpty()


def test_models_do_not_depend_on_the_layout_of_their_rows(spark):
    """Another order, other parts and another file name give the same forest and sweep."""
    from georisk.operators import models
    from driver_queries import queries

    rows = settle(queries.history(spark, "/root/testdata/sf0.001"), "history")
    found = []
    for layout in (rows.coalesce(1), rows.orderBy(F.desc("risk")).repartition(7)):
        table = settle(layout, "layout")
        bundle = models.train_forest(table, queries.ROLES, trees=3, depth=4, key="occ_id")
        scores = models.score_history(table, bundle, queries.ROLES).select("occ_id", "predicted")
        sweep = models.kmeans_sweep(table, list(queries.SCALED), range(2, 4), iterations=5)
        found.append((sorted(map(tuple, scores.collect())), [
            (r["k"], round(r["inertia"], 6), round(r["silhouette"], 6)) for r in sweep.collect()]))
    assert found[0] == found[1]


def test_parts_follow_the_setting_and_not_the_cores(spark):
    table = settle(spark.range(0, 1000, 1, 1))
    laid = lay_out(table, ["id"], 12)
    assert laid.rdd.getNumPartitions() == 12
    parts = laid.select("id", F.spark_partition_id().alias("p")).collect()
    again = lay_out(table.repartition(5), ["id"], 12).select("id", F.spark_partition_id().alias("p")).collect()
    assert list(map(tuple, parts)) == list(map(tuple, again))


def test_cleaning_reaches_the_scan(spark):
    path = new_path(spark, "pushdown")
    roles = Roles()
    spark.range(10).select(
        *[F.col("id").cast("double").alias(name) for name in roles.measures], "id"
    ).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(clean(spark.read.parquet(path), roles).select("id"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    for name in roles.measures:
        assert f"IsNotNull({name})" in pushed and f"EqualNullSafe({name},-999.0)" in pushed

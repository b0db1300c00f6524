"""Clusterings of several k by shared scans, against plain reckoning."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from georisk.operators import models, sweep as s


def points(spark, count=600):
    noise = lambda seed: (F.xxhash64("id", F.lit(seed)) % 1000).cast("double") / 900.0
    return spark.range(count).select(
        (F.col("id") % 4 * 10 + noise(1)).alias("a"), (F.col("id") % 4 % 2 * 10 + noise(2)).alias("b"))


def plain_silhouette(x, labels):
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    out = []
    for i, own in enumerate(labels):
        means = {c: apart[i, labels == c] for c in np.unique(labels)}
        if len(means[own]) == 1:
            out.append(0.0)
            continue
        inner = means[own].sum() / (len(means[own]) - 1)
        outer = min(values.mean() for c, values in means.items() if c != own)
        out.append((outer - inner) / max(outer, inner))
    return float(np.mean(out))


def test_one_scan_serves_all_k(spark, monkeypatch):
    scans = []
    real = s.scan
    monkeypatch.setattr(s, "scan", lambda packed, centres, *rest: scans.append(sorted(centres)) or real(packed, centres, *rest))
    found = models.kmeans_sweep(points(spark), ["a", "b"], [2, 3, 4, 5]).collect()
    assert [r["k"] for r in found] == [2, 3, 4, 5]
    assert scans[0] == scans[-1] == [2, 3, 4, 5] and len(scans) < 30
    inertia = [r["inertia"] for r in found]
    assert inertia == sorted(inertia, reverse=True)
    assert max(found, key=lambda r: r["silhouette"])["k"] == 4


def test_silhouette_and_inertia_equal_plain_ones(spark):
    rows = points(spark)
    found = models.kmeans_sweep(rows, ["a", "b"], [4]).first()
    x = np.array([tuple(r) for r in rows.orderBy("a", "b").collect()])
    x = (x - x.mean(0)) / x.std(0)
    labels = np.digitize(x[:, 0], np.quantile(x[:, 0], [0.25, 0.5, 0.75]))
    assert np.bincount(labels).tolist() == [150] * 4
    cost = sum(((x[labels == c] - x[labels == c].mean(0)) ** 2).sum() for c in range(4))
    assert found["inertia"] == pytest.approx(cost)
    assert found["silhouette"] == pytest.approx(plain_silhouette(x, labels))


def test_more_clusters_than_places(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("double").alias("a"), F.lit(1.0).alias("b"))
    found = {r["k"]: r for r in models.kmeans_sweep(rows, ["a", "b"], [2, 5]).collect()}
    assert found[2]["inertia"] == pytest.approx(0) and found[2]["silhouette"] == pytest.approx(1)
    assert found[5]["inertia"] == pytest.approx(0)


def test_blocks_added_in_two_steps_give_the_same(spark, monkeypatch):
    expected = [tuple(r) for r in models.kmeans_sweep(points(spark), ["a", "b"], [3, 4]).collect()]
    monkeypatch.setattr(s, "ADDED", 2)
    monkeypatch.setattr(s, "BLOCK", 16)
    again = [tuple(r) for r in models.kmeans_sweep(points(spark), ["a", "b"], [3, 4]).collect()]
    assert np.allclose(expected, again)


def test_no_rows_are_an_error(spark):
    with pytest.raises(ValueError, match="no rows"):
        models.kmeans_sweep(points(spark).limit(0), ["a", "b"], [2])


def test_first_centres_come_from_rows_and_not_from_values(spark, monkeypatch):
    monkeypatch.setattr(s, "START_ROWS", 200)
    for value in range(3):  # A hash of the values takes all copies of a value or none.
        place = F.pow(F.lit(40.0), F.col("id") % 2 + 1) * (F.col("id") % 4 >= 2).cast("double") + F.col("id") % 2 + value
        rows = spark.range(4000).select(place.alias("a"), (place * 3 + value).alias("b"))
        found = models.kmeans_sweep(rows, ["a", "b"], [4]).first()
        assert found["inertia"] == pytest.approx(0, abs=1e-6) and found["silhouette"] == pytest.approx(1)


def test_tasks_take_few_blocks_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 16)
    packed = s.settle(s.pack_blocks(points(spark).coalesce(1), ["a", "b"]), "blocks")

    def most(batches):
        yield s.pa.RecordBatch.from_pydict({"most": [max(b.num_rows for b in batches)]})

    before = spark.conf.get(s.BATCH_CONF)
    with s.few_at_once(spark):
        assert packed.coalesce(1).mapInArrow(most, "most long").first()[0] <= s.TAKEN
    assert spark.conf.get(s.BATCH_CONF) == before
    expected = s.sweep(points(spark).coalesce(1), ["a", "b"], [3], 657, 20)
    monkeypatch.setattr(s, "few_at_once", lambda session: s.contextmanager(lambda: (yield))())
    assert np.allclose(expected, s.sweep(points(spark).coalesce(1), ["a", "b"], [3], 657, 20))

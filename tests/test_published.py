"""The forest queries train at the published settings."""

from __future__ import annotations

from driver_queries import queries
from georisk.operators import models


def test_forest_queries_take_the_library_defaults(spark, monkeypatch):
    given = []
    monkeypatch.setattr(queries, "load_or_train", lambda *args, **settings: given.append(settings))
    queries.published_forest(spark, None)
    assert given and all(set(settings) <= {"key"} for settings in given)
    assert (models.TREES, models.DEPTH) == (200, 20)

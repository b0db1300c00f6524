from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


LONG = "word " * 30_000
ODD_ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 3),
    (4, "one two", "en", "a", 7), (5, "one two", "en", "b", 7), (5, "one two", "en", "b", 7),
    (None, "a line that is long enough to count\nother", "en", "a", 40),
    (6, "a line that is long enough to count\nA LINE that is long enough to count ", "de", "c", 70),
    (7, "a line that is long enough to count", "de", "c", 35), (8, LONG, "en", "a", len(LONG)),
    (9, "é ß 　 日本語 " * 30, "xx", "é", 10), (10, "\n" * 500, "en", "a", 500),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank, short, repeated and very long texts, with columns named like results."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD_ROWS, DOCS)
    clashing = ("size", "target", "taken", "piece", "length", "score", "kept", "n_lines", "n_links", "id", "rep")
    return docs.withColumns({name: F.lit("x") for name in clashing})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

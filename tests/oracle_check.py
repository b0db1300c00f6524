"""Runs a query on Spark and its SQL on DuckDB and compares whole results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "null" if value is None else str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = sorted(tuple(plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], table


# Spark type name to DuckDB type name.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}

# Plan nodes no query should need: cross joins and Python workers.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def compare(spark, db, query, sql, sf_dir):
    """None if equal, else a short description of the first difference."""
    result = query(spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for node in UNWANTED:
        if node in plan:
            return f"plan has {node}"
    left = canonical(result.columns, [tuple(row) for row in result.collect()])
    cursor = db.execute(sql)
    right = canonical([part[0] for part in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    types = {part[0]: str(part[1]) for part in cursor.description}
    for name, kind in result.dtypes:
        if TYPE_NAMES.get(kind) != types[name]:
            return f"column {name} is {kind} against {types[name]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows against {len(right[1])}"
    different = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    return None


def main(sf: str, names: list[str]) -> int:
    from tests.conftest import make_session
    import __spark_entry__ as entry

    spark, sf_dir = make_session(), str(TESTDATA / sf)
    db, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, db, query, sqls[name], sf_dir)
            else:
                rows = query(spark, sf_dir).count()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql" if name in sqls else "rows"
        print(f"{name:28s} {kind:4s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

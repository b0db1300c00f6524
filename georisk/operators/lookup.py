"""Left and inner lookups of a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from georisk.functions.scalars import any_of
from georisk.workspace import settle

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32
HOT_SHARE = 0.002  # at most 1 / HOT_SHARE keys can hold more than this share

_HOT = "__hot_key"


def row_bytes(table: DataFrame) -> Column:
    """Size of a row once it is unpacked in memory."""
    texts = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = F.lit(ROW_OVERHEAD + 8 * len(table.columns)).cast("long")
    return reduce(
        lambda total, name: total + F.coalesce(F.octet_length(name), F.lit(0)), texts, fixed
    )


def table_bytes(table: DataFrame) -> int:
    """Size of a table, measured, not guessed."""
    return table.agg(F.sum(row_bytes(table)).alias("size")).first()["size"] or 0


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    size: int | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table``, which holds at most one row per key.

    Without a measured ``size`` the table is written once and measured. Within
    ``broadcast_bytes`` (by default ``BROADCAST_BYTES``) it is sent to every
    executor and ``rows`` are not shuffled. Beyond it, see ``hot_key_join``.
    """
    on = list(on)
    if size is None:
        table = settle(table, "lookup")
        size = table_bytes(table)
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if size <= limit:
        return rows.join(F.broadcast(table), on, how)
    return hot_key_join(rows, table, on, how)


def hot_key_join(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Shuffle join that never sends a hot key's rows to one task.

    Keys holding more than ``HOT_SHARE`` of the rows are fewer than
    ``1 / HOT_SHARE`` by arithmetic, so their table rows always fit a broadcast
    and their rows stay where they are, as do rows with a null key, which match
    nothing. Only the remaining, evenly spread keys are shuffled.
    """
    on = list(on)
    # Read three times below; without the written copy its whole plan would run as often.
    rows = settle(rows, "lookup-rows")
    null_key = any_of([F.col(name).isNull() for name in on])
    counts = settle(rows.filter(~null_key).groupBy(*on).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = settle(counts.filter(F.col("count") > total * HOT_SHARE).select(*on), "hot-keys")

    marked = rows.join(F.broadcast(hot.withColumn(_HOT, F.lit(True))), on, "left")
    stays = F.col(_HOT).isNotNull() | null_key
    hot_table = table.join(F.broadcast(hot), on, "left_semi")
    hot_part = marked.filter(stays).drop(_HOT).join(F.broadcast(hot_table), on, how)
    even_part = marked.filter(~stays).drop(_HOT).join(table, on, how)
    return hot_part.unionByName(even_part)

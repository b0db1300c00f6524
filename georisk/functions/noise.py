"""Repeatable noise: a hash of the row id instead of a random generator.

The value depends on the id, the topic and the seed only, so a task that is run
again after a lost executor, or with another number of partitions, draws the
same numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from georisk.functions.scalars import column

HEX_DIGITS = 8
SLOTS = 4  # a digest has 32 hex digits


def digest(row_id: Column | str, topic: str, seed: int) -> Column:
    return F.md5(F.concat(column(row_id).cast("string"), F.lit(f":{topic}:{seed}")))


def uniform(hashed: Column, slot: int) -> Column:
    """One of the four numbers in [0, 1) that a digest holds."""
    if not 0 <= slot < SLOTS:
        raise ValueError(f"slot {slot} is outside 0..{SLOTS - 1}")
    part = F.substring(hashed, 1 + slot * HEX_DIGITS, HEX_DIGITS)
    return F.conv(part, 16, 10).cast("double") / F.lit(float(16**HEX_DIGITS))


def normal(first: Column, second: Column) -> Column:
    """Standard normal from two uniforms (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - first))
    return radius * F.cos(F.lit(2.0 * math.pi) * second)


def whole(u: Column, low: int, high: int) -> Column:
    """Integer from low up to, not including, high."""
    return (F.lit(low) + F.floor(u * F.lit(float(high - low)))).cast("int")


def between(u: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + u * F.lit(float(high - low))

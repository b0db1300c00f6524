"""Column expressions. All of them are built-in JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Texts that stand for a missing value in the input files.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Outcome classes and the colours they are drawn in.
OUTCOME_HIT = "ACERTO"
OUTCOME_OVER = "SOBRE"
OUTCOME_UNDER = "SUB"
OUTCOME_COLOURS = {"ACERTO": "green", "SOBRE": "orange", "SUB": "red"}
OTHER_COLOUR = "gray"

BLANKS = " \t\n\r\f\v"
NUMBER = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    return F.trim(column(text), F.lit(BLANKS))


def drop_null_tokens(text: Column | str) -> Column:
    text = column(text)
    return F.when(~text.isin(*NULL_TOKENS), text)


def parse_time(text: Column | str) -> Column:
    """Text to timestamp; days may be written with dashes or slashes.

    Text that is no time gives null. One cast per value, whatever the layout,
    and no time zone is involved, so no hour is skipped or doubled.
    """
    return F.translate(strip(text), "/", "-").try_cast("timestamp_ntz")


def parse_date(text: Column | str) -> Column:
    return F.to_date(parse_time(text))


def parse_number(text: Column | str) -> Column:
    """Text to double; anything that is not a plain number gives null."""
    text = strip(text)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def unparsed_number(text: Column | str) -> Column:
    """Whether a text is neither missing nor a plain number; never null."""
    text = drop_null_tokens(strip(text))
    return text.isNotNull() & parse_number(text).isNull()


def typed_number(text: Column | str) -> Column:
    """Text to double; a missing value gives null, any other text that is no number fails."""
    problem = F.concat(F.lit("not a number: "), column(text))
    return F.when(unparsed_number(text), F.raise_error(problem).cast("double")).otherwise(
        parse_number(text)
    )


def nan_to_null(value: Column | str) -> Column:
    value = column(value)
    return F.when(~F.isnan(value), value)


def present(value: Column | str, floating: bool = True) -> Column:
    """Neither null nor NaN, written so that the null half reaches the scan."""
    value = column(value)
    return value.isNotNull() & ~F.isnan(value) if floating else value.isNotNull()


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def clip(value: Column | str, low: Column | float, high: Column | float) -> Column:
    """Limit to [low, high]; null and NaN stay as they are."""
    value = column(value)
    low, high = F.lit(low), F.lit(high)
    return (
        F.when(F.isnan(value), value)
        .when(value < low, low)
        .when(value > high, high)
        .otherwise(value)
    )


def floor_zero(value: Column | str) -> Column:
    """The value, but never below 0; an unknown value counts as 0."""
    return F.greatest(F.lit(0), column(value))


def round_half_even(value: Column | str, digits: int = 0) -> Column:
    value = column(value)
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def percent_ceiling(share: Column | str) -> Column:
    return F.ceil(column(share) * F.lit(100.0)).cast("int")


def text_or_nan(value: Column | str) -> Column:
    """Category text; a missing category is the text ``nan``."""
    return F.coalesce(column(value).cast("string"), F.lit("nan"))


def absolute_error(truth: Column | str, predicted: Column | str) -> Column:
    return F.abs(column(truth) - column(predicted))


def outcome(truth: Column | str, predicted: Column | str, margin: float = 10.0) -> Column:
    truth, predicted = column(truth), column(predicted)
    return (
        F.when(absolute_error(truth, predicted) <= margin, OUTCOME_HIT)
        .when(predicted > truth, OUTCOME_OVER)
        .otherwise(OUTCOME_UNDER)
    )


def outcome_colour(result: Column | str) -> Column:
    result = column(result)
    pairs = [F.lit(part) for pair in OUTCOME_COLOURS.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), result), F.lit(OTHER_COLOUR))


def dry_season(month: Column | str) -> Column:
    return column(month).between(5, 10)


def days_in_month(day: Column | str) -> Column:
    return F.dayofmonth(F.last_day(column(day)))

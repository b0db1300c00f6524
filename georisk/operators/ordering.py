"""Global positions without sending a table through one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from georisk.functions.scalars import nan_to_null
from georisk.workspace import settle

SLICE = "__slice"
PLACE = "__place"
ACCURACY = 10_000  # of the quantile sketch: its rank error is at most 1 / ACCURACY
MARGIN = 4.0 / ACCURACY
_PARTITION_BITS = 33  # documented layout of monotonically_increasing_id


def sliced(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort into range slices; each row knows its slice and its place in it.

    ``order`` must be a total order. The result is written once, so positions
    computed from it in separate steps agree even if tasks are run again.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id()
    placed = ordered.select(
        "*",
        F.shiftright(position, _PARTITION_BITS).cast("int").alias(SLICE),
        position.bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1)).alias(PLACE),
    )
    return settle(placed, "slices")


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row under a total order.

    Only one number per slice is combined across slices; the window below
    therefore sees no more rows than there are shuffle partitions.
    """
    cut = sliced(df, order)
    sizes = cut.groupBy(SLICE).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        SLICE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    return (
        cut.join(F.broadcast(starts), SLICE)
        .withColumn(name, F.col("__start") + F.col(PLACE))
        .drop(SLICE, PLACE, "__start")
    )


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """Add 0-based positions in no particular order, without any shuffle.

    The rows are written once as they lie, each part counts its own rows, and
    only the counts are combined.
    """
    position = F.monotonically_increasing_id()
    placed = settle(df.withColumn(PLACE, position), "numbered")
    part = F.shiftright(PLACE, _PARTITION_BITS)
    sizes = placed.groupBy(part.alias(SLICE)).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        SLICE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    inside = F.col(PLACE).bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    return (
        placed.withColumn(SLICE, part)
        .join(F.broadcast(starts), SLICE)
        .withColumn(name, F.col("__start") + inside)
        .drop(SLICE, PLACE, "__start")
    )


def group_at(counts: DataFrame, order: Sequence[Column], weight: str, position: int) -> Row:
    """The group that covers a 0-based position, if groups are laid out in order.

    ``counts`` has one row per group and its number of rows in ``weight``. The
    result has the number of rows ``before`` the group. Only the one slice that
    holds the position is read again.
    """
    cut = sliced(counts, order)
    sizes = cut.groupBy(SLICE).agg(F.sum(weight).alias("n")).orderBy(SLICE)
    start, chosen = 0, None
    for number, size in sizes.collect():  # no more rows than shuffle partitions
        chosen = number
        if start + size > position:
            break
        start += size
    running = Window.partitionBy(SLICE).orderBy(PLACE)
    reached = cut.filter(F.col(SLICE) == chosen).withColumn(
        "before", F.lit(start) + F.sum(weight).over(running) - F.col(weight)
    )
    covers = (F.col("before") <= position) & (F.col("before") + F.col(weight) > position)
    return reached.filter(covers).first()


def exact_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column; missing values are skipped.

    A first pass brackets each median with an approximate quantile, which
    shuffles nothing but sketches. A second pass counts the values inside the
    brackets and lumps everything below into one group, so only a sliver of the
    values is shuffled. Should a bracket miss its median, that column is
    counted again without one.
    """
    numbers = {name: nan_to_null(F.col(name).cast("double")) for name in columns}
    facts = df.agg(*[
        F.struct(
            F.count(value).alias("n"),
            F.percentile_approx(value, [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias("ends"),
        ).alias(name)
        for name, value in numbers.items()
    ]).first()
    sizes = {name: facts[name]["n"] for name in columns if facts[name]["n"]}
    medians = medians_within(df, sizes, {name: facts[name]["ends"] for name in sizes})
    missed = [name for name in sizes if medians[name] is None]
    if missed:
        everything = {name: (float("-inf"), float("inf")) for name in missed}
        medians |= medians_within(df, {name: sizes[name] for name in missed}, everything)
    schema = ", ".join(f"`{name}` double" for name in columns)
    return df.sparkSession.createDataFrame([tuple(medians.get(name) for name in columns)], schema)


def medians_within(
    df: DataFrame, sizes: Mapping[str, int], brackets: Mapping[str, Sequence[float]]
) -> dict[str, float | None]:
    """Exact medians of columns with known sizes; None if outside its bracket."""
    if not sizes:
        return {}

    def pair(name: str) -> Column:
        low, high = brackets[name]
        value = nan_to_null(F.col(name).cast("double"))
        inside = F.when(value >= low, value)  # null stands for all values below
        entry = F.struct(F.lit(name).alias("axis"), inside.alias("value"))
        return F.when(value <= high, entry)

    pairs = F.explode(F.array(*[pair(name) for name in sizes])).alias("p")
    values = df.select(pairs).filter(F.col("p").isNotNull()).select("p.axis", "p.value")
    counts = values.groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n"))
    cut = sliced(counts, [F.col("axis"), F.col("value").asc_nulls_first()])

    # As many rows as slices times columns, with the two middle positions.
    upto = Window.partitionBy("axis").orderBy(SLICE)
    known = F.create_map(*[F.lit(part) for item in sizes.items() for part in item])
    total = F.element_at(known, F.col("axis"))
    spans = cut.groupBy("axis", SLICE).agg(F.sum("n").alias("span")).select(
        "axis", SLICE, (F.sum("span").over(upto) - F.col("span")).alias("start"),
        F.sum("span").over(upto).alias("end"), total.alias("total"),
    ).withColumns({"low": F.expr("(total - 1) div 2"), "high": F.expr("total div 2")})
    middle = spans.filter((F.col("start") <= F.col("high")) & (F.col("end") > F.col("low")))

    near = cut.join(F.broadcast(middle), ["axis", SLICE])
    running = Window.partitionBy("axis", SLICE).orderBy(PLACE)
    before = F.col("start") + F.sum("n").over(running) - F.col("n")
    reached = near.withColumn("before", before)

    def value_at(position: str) -> Column:
        covers = (F.col("before") <= F.col(position)) & (
            F.col("before") + F.col("n") > F.col(position)
        )
        return F.max(F.when(covers, F.col("value")))

    found = reached.groupBy("axis").agg(
        ((value_at("low") + value_at("high")) / F.lit(2.0)).alias("median")
    ).collect()  # a row per column
    return {name: None for name in sizes} | {row["axis"]: row["median"] for row in found}

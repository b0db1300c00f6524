"""Connected components of a table of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from georisk.workspace import settle


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component) for every id with a link to another one.

    The component is the smallest id that can be reached. Each round hooks
    every id to its best neighbour and contracts the links, so the table of
    links shrinks by a constant share on average; the first round takes the
    smallest neighbour (which ends stars at once), later rounds a seeded hash,
    so that long chains shrink as well. Minima combine before the shuffle and
    the joins have one row per id on one side, so a hub with a third of all
    links is split by the skew join. Rounds are written to the shared folder.
    """
    links = settle(_ordered(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()), "links")
    spark = links.sparkSession
    if links.isEmpty():
        return spark.createDataFrame([], "id long, component long")
    rounds: list[DataFrame] = []
    while not rounds or not links.isEmpty():
        step = len(rounds)

        def rank(name: str) -> Column:
            return F.col(name) if step == 0 else F.xxhash64(F.lit(step), F.col(name))

        ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(
            links.select(F.col("b").alias("id"), F.col("a").alias("other")))
        best = ends.groupBy("id").agg(F.min(F.struct(rank("other").alias("r"), "other")).alias("m"))
        hooks = settle(best.select("id", F.least(
            F.struct(rank("id").alias("r"), F.col("id").alias("other")), "m")["other"].alias("to")), "hooks")
        rounds.append(hooks)
        left = hooks.select(F.col("id").alias("a"), F.col("to").alias("ta"))
        right = hooks.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        moved = links.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        links = settle(_ordered(moved), "links")
    labels = rounds[0]
    for hooks in rounds[1:]:
        following = hooks.select(F.col("id").alias("to"), F.col("to").alias("next"))
        labels = labels.join(following, "to", "left").select(
            "id", F.coalesce("next", "to").alias("to"))
    if len(rounds) == 1:
        return labels.select("id", F.col("to").alias("component"))
    labels = settle(labels, "labels")
    least = labels.groupBy("to").agg(F.min("id").alias("component"))
    return labels.join(least, "to").select("id", "component")

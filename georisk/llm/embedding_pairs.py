"""Exact near pairs of embeddings by dual traversal of cover trees.

Vectors with one label are dealt to the cells of a few pivots, cells whose
covering balls are too far apart are skipped, and the other cells meet in tiles
of two blocks. In a tile each block becomes a cover tree: nested levels of
nodes whose radius halves from level to level. Pairs of nodes are dropped when
the distance of their centres exceeds both covering radii and the threshold's
distance, taken whole when even their farthest points are near enough, and
otherwise split; single vectors are compared by cosine in double precision.

Equal vectors of a label are one class, compared once. Links are counted where
they are found and not written out, so a group of thousands of near vectors
costs no quadratic table.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components, or have a null label or id link with nothing and are their own
component; vectors of different lengths are never compared; rows that repeat id,
label and vector are one vector, rows with one id and different vectors are
vectors of their own; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from georisk.llm.graph import components
from georisk.llm.ngram_join import Forest, by_tile
from georisk.workspace import settle

BLOCK, PIVOTS, LEAF = 1024, 64, 16
# Distances come from cosines, whose rounding the square root enlarges.
SLACK = 1e-6


def vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each vector in double precision; None if it can't be compared."""
    for item in column:
        values = item.as_py()
        if not values or any(x is None for x in values):
            yield None
            continue
        vector = np.array(values, np.float64)
        yield vector if np.isfinite(vector).all() and np.abs(vector).max() > 0 else None


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, raw): ids with their vector as bytes, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            raw, dims = [], []
            for key, label, vector in zip(ids, labels, vectors(batch.column(2))):
                fine = vector is not None and label is not None and key is not None
                # Scaling by the largest component keeps norms finite and changes no cosine.
                raw.append((vector / np.abs(vector).max()).tobytes() if fine else None)
                dims.append(len(vector) if fine else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                names=["id", "label", "dim", "raw"])

    narrow = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).alias("vector"))
    return narrow.mapInArrow(run, "id long, label string, dim int, raw binary")


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def units(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chord lengths between unit vectors."""
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def assign_cells(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """Nearest pivot of each row, and the distance to it."""
    if not rows.num_rows:
        return pa.table({"rep": pa.array([], pa.int64()), "cell": pa.array([], pa.int32()), "far": pa.array([], pa.float64())})
    dim = rows.column("dim")[0].as_py()
    pivots = pivots.sort_by("cell")
    far = distances(units(matrix(rows.column("raw"), dim)), units(matrix(pivots.column("raw"), dim)))
    cell = far.argmin(1)
    numbers = pivots.column("cell").to_numpy()
    return pa.table({
        "rep": rows.column("rep"), "cell": pa.array(numbers[cell].astype(np.int32)),
        "far": pa.array(far[np.arange(len(cell)), cell])})


def near_cells(limit: float):
    """For the cells of one label: those pairs whose balls may hold a linked pair, both ways."""

    def run(cells: pa.Table) -> pa.Table:
        dim = cells.column("dim")[0].as_py()
        unit = units(matrix(cells.column("raw"), dim))
        radius, number = cells.column("radius").to_numpy(), cells.column("cell").to_numpy()
        blocks = cells.column("blocks").to_numpy()
        a, b = np.nonzero(distances(unit, unit) <= radius[:, None] + radius[None, :] + limit + SLACK)
        return pa.table({
            "label": pa.array([cells.column("label")[0].as_py()] * len(a), pa.string()),
            "dim": pa.array(np.full(len(a), dim, np.int32)), "cell": pa.array(number[a]),
            "blocks": pa.array(blocks[a]), "other": pa.array(number[b]), "other_blocks": pa.array(blocks[b])})

    return run


class Node:
    """A ball around a centre: the points in it, its true covering radius, and smaller balls."""

    __slots__ = ("centre", "points", "radius", "children")

    def __init__(self, centre: int, points: np.ndarray, radius: float):
        self.centre, self.points, self.radius = centre, points, radius
        self.children: list[Node] = []


def cover_tree(unit: np.ndarray, points: np.ndarray) -> Node:
    """Levels of halving radii: at each level the balls of a node's children cover its points."""
    root = Node(int(points[0]), points, float(distances(unit[points[:1]], unit[points])[0].max()))
    waiting = [(root, 1.0)]
    while waiting:
        node, reach = waiting.pop()
        if len(node.points) <= LEAF or node.radius <= SLACK:
            continue
        while reach > node.radius / 2:
            reach /= 2
        left = node.points
        while len(left):
            far = distances(unit[left[:1]], unit[left])[0]
            inside = far <= reach
            inside[0] = True
            child = Node(int(left[0]), left[inside], float(far[inside].max()))
            node.children.append(child)
            waiting.append((child, reach / 2))
            left = left[~inside]
    return root


class Links:
    """Counts of linked vectors, and parts tied by links, of the rows of a tile."""

    def __init__(self, raw: np.ndarray, copies: np.ndarray, threshold: float):
        self.raw, self.copies, self.threshold = raw, copies, threshold
        self.norms = np.sqrt((raw * raw).sum(1))
        self.unit = raw / self.norms[:, None]
        self.limit = math.sqrt(2 - 2 * threshold)
        self.counts = np.zeros(len(raw), np.int64)
        self.forest = Forest(len(raw))

    def compare(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """All pairs of two point sets by cosine; pairs within one set once."""
        near = (self.raw[a] @ self.raw[b].T) / (self.norms[a][:, None] * self.norms[b][None, :]) >= self.threshold
        if same:
            near = np.triu(near, 1)
        x, y = np.nonzero(near)
        np.add.at(self.counts, a[x], self.copies[b[y]])
        np.add.at(self.counts, b[y], self.copies[a[x]])
        for i, j in zip(a[x].tolist(), b[y].tolist()):
            self.forest.join(i, j)

    def take_all(self, a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """Every pair of two point sets is linked."""
        if same:
            self.counts[a] += self.copies[a].sum() - self.copies[a]
        else:
            self.counts[a] += self.copies[b].sum()
            self.counts[b] += self.copies[a].sum()
        for i in np.concatenate([a, b]).tolist():
            self.forest.join(int(a[0]), i)

    def visit(self, a: Node, b: Node) -> None:
        """Dual traversal; ``a is b`` stands for the pairs within one node."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            same = a is b
            apart = 0.0 if same else float(distances(self.unit[[a.centre]], self.unit[[b.centre]])[0, 0])
            if apart > a.radius + b.radius + self.limit + SLACK:
                continue
            if apart + a.radius + b.radius < self.limit - SLACK:
                self.take_all(a.points, b.points, same)
            elif not a.children and not b.children:
                self.compare(a.points, b.points, same)
            elif same:
                waiting += self.near_children(a.children, a.children, True)
            else:
                left = a.children if a.children and (not b.children or a.radius >= b.radius) else [a]
                right = b.children if b.children and (not a.children or b.radius >= a.radius) else [b]
                waiting += self.near_children(left, right, False)

    def near_children(self, a: list[Node], b: list[Node], same: bool) -> list[tuple[Node, Node]]:
        far = distances(self.unit[[x.centre for x in a]], self.unit[[x.centre for x in b]])
        reach = np.array([x.radius for x in a])[:, None] + np.array([x.radius for x in b])[None, :]
        near = far <= reach + self.limit + SLACK
        if same:
            near = np.triu(near, 1) | np.diag([len(x.points) > 1 for x in a])
        return [(a[i], b[j]) for i, j in zip(*np.nonzero(near))]


def tile_links(tile: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of a tile, linked vectors of each, and the smallest member it reaches."""
    tile = tile.sort_by("rep")
    ids = tile.column("rep").to_numpy()
    links = Links(matrix(tile.column("raw"), tile.column("dim")[0].as_py()), tile.column("copies").to_numpy(), threshold)
    side = tile.column("side").to_numpy()
    trees = [cover_tree(links.unit, np.flatnonzero(side == s)) for s in (0, 1) if (side == s).any()]
    both = tile.column("within")[0].as_py()
    if both:
        links.visit(trees[0], trees[0])
    elif len(trees) == 2:
        links.visit(trees[0], trees[1])
    roots = ids[[links.forest.root(i) for i in range(len(ids))]]
    return ids, links.counts, roots


def cosine_links(
    rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label are linked when their cosine is at least ``threshold``.
    ``component_id`` is the smallest id reachable by links, itself included.
    """
    limit = math.sqrt(2 - 2 * threshold)
    all_rows = settle(usable(rows, id_col, vector_col, label_col).distinct(), "vectors")
    group = ["label", "dim"]
    # Classes are numbered: one id may have several vectors.
    classes = settle(all_rows.where("raw is not null").groupBy(*group, "raw").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")).withColumn(
        "rep", F.monotonically_increasing_id()), "vector_classes")
    sizes = classes.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).select(
        *group, F.ceil(F.col("n") / BLOCK).alias("parts"),
        F.least(F.lit(PIVOTS), F.ceil(F.col("n") / BLOCK)).alias("pivots"))
    sized = classes.join(sizes, group).withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    # One pivot for each remainder: a minimum, so it combines before the shuffle.
    pivots = settle(sized.groupBy(*group, "parts", F.pmod(F.xxhash64(F.lit(3), "rep"), "pivots").cast("int").alias("cell")).agg(
        F.min_by("raw", F.xxhash64(F.lit(4), "rep")).alias("raw")), "pivots")
    copies = pivots.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    key = [*group, "part"]
    dealt = sized.select(*key, "rep", "raw").groupBy(*key).cogroup(
        copies.select(*key, "cell", "raw").groupBy(*key)).applyInArrow(assign_cells, "rep long, cell int, far double")
    placed = settle(classes.join(dealt, "rep"), "placed")

    cells = placed.groupBy(*group, "cell").agg(
        F.max("far").alias("radius"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    cells = cells.join(pivots.select(*group, "cell", "raw"), [*group, "cell"])
    routes = cells.groupBy("label", "dim").applyInArrow(
        near_cells(limit), "label string, dim int, cell int, blocks long, other int, other_blocks long")
    met = placed.join(routes, [*group, "cell"])
    own = F.pmod(F.xxhash64(F.lit(9), "rep"), "blocks")
    met = met.withColumn("block", own).withColumn(
        "partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1)))
    mine, theirs = F.struct(F.col("cell").alias("c"), F.col("block").alias("b")), F.struct(
        F.col("other").alias("c"), F.col("partner").alias("b"))
    keys = [*group, "c1", "b1", "c2", "b2"]
    tiles = met.select(
        *group, F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y"),
        (mine > theirs).cast("int").alias("side"), (mine == theirs).alias("within"), "rep", "copies", "raw").select(
        *group, F.col("x.c").alias("c1"), F.col("x.b").alias("b1"), F.col("y.c").alias("c2"), F.col("y.b").alias("b2"),
        "side", "within", "rep", "copies", "raw")
    hashed = tiles.withColumn("tile", F.xxhash64(*keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in by_tile(batches, ["tile"]):
            ids, linked, roots = tile_links(tile, threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(linked), pa.array(roots)], names=["rep", "linked", "root"])

    found = settle(hashed.repartition("tile").sortWithinPartitions("tile").mapInArrow(
        run, "rep long, linked long, root long"), "tile_links")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    reached = components(found, "rep", "root").withColumnRenamed("id", "rep")
    facts = settle(classes.join(linked.join(reached, "rep", "left"), "rep", "left"), "class_facts")
    least = facts.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id"))
    facts = facts.join(least, "component", "left")
    good = all_rows.where("raw is not null").join(facts, [*group, "raw"]).select(
        "id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least_id", "first_id").alias("component_id"))
    alone = all_rows.where("raw is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return good.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

"""Clusterings for many numbers of clusters at once.

The rows lie scaled in blocks. Every scan moves the centres of all numbers of
clusters that have not settled, so scans follow the longest run of iterations
and not their sum. Blocks and the order in which their sums are added depend on
the rows only, so another cluster gives the same centres.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from georisk.operators.forest import mix
from georisk.workspace import settle

# Vectors of a block, rows that the first centres come from, sums added by one task, the
# squared movement of all centres, in units of the variance, below which they have settled,
# and blocks that a task takes from Spark at a time.
BLOCK, START_ROWS, ADDED, SETTLED, TAKEN = 1 << 15, 20_000, 4096, 1e-4, 2
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
SUMS_SCHEMA = "k int, block long, sums binary"

Centres = dict[int, np.ndarray]


def pack_blocks(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in a fixed order as blocks of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close() -> pa.RecordBatch:
            body = np.concatenate(held)
            return pa.RecordBatch.from_pydict({"block": [block], "body": [body.astype("<f8").tobytes()]})

        for batch in batches:
            vectors = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            while len(vectors):
                part = vectors[:BLOCK - size]
                held, size, vectors = [*held, part], size + len(part), vectors[len(part):]
                if size == BLOCK:
                    yield close()
                    block, held, size = block + 1, [], 0
        if held:
            yield close()

    return rows.select(*columns).mapInArrow(run, "block long, body binary")


@contextmanager
def few_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks get ``TAKEN`` blocks at a time, and not all of a file in one batch."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(TAKEN))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def blocks_in(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number and vectors of each block, without copies of the bodies."""
    for batch in batches:
        numbers, bodies = batch.columns
        for number, body in zip(numbers, bodies):
            yield number.as_py(), np.frombuffer(body.as_buffer(), "<f8").reshape(-1, dims)


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * x @ centres.T + (centres * centres).sum(1), 0.0)


def block_sums(x: np.ndarray, labels: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """Per cluster: rows, sum of squared distances, sum of squared lengths, and sums of the vectors."""
    member = (labels[:, None] == np.arange(k)).astype(np.float64)
    return np.column_stack([member.sum(0), member.T @ off, member.T @ (x * x).sum(1), member.T @ x])


def add_up(sums: DataFrame) -> DataFrame:
    """One row per k; blocks are added in their order."""

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("block").to_numpy(), kind="stable")
        bodies = table.column("sums")
        total = np.zeros(len(bodies[0].as_py()) // 8)
        for i in order:
            total += np.frombuffer(bodies[int(i)].as_py(), "<f8")
        return pa.table({"k": pa.array([table.column("k")[0].as_py()], pa.int32()),
                         "block": [int(table.column("block").to_numpy().min())], "sums": [total.tobytes()]})

    return sums.groupBy("k").applyInArrow(add, SUMS_SCHEMA)


def collected(sums: DataFrame, blocks: int, columns: int) -> dict[int, np.ndarray]:
    """The sums of every k, added in two steps where there are many blocks."""
    if blocks > ADDED:
        span = (F.col("block") % F.lit(-(-blocks // ADDED))).cast("int")
        keyed = sums.select((F.col("k") + F.lit(1 << 16) * span).alias("k"), "block", "sums")
        sums = add_up(keyed).select((F.col("k") % F.lit(1 << 16)).alias("k"), "block", "sums")
    with few_at_once(sums.sparkSession):
        rows = add_up(sums).collect()  # one row per k
    return {row["k"]: np.frombuffer(row["sums"], "<f8").reshape(-1, columns) for row in rows}


def scan(packed: DataFrame, centres: Centres, dims: int, blocks: int) -> dict[int, np.ndarray]:
    """One pass: ``block_sums`` of the clusters nearest to each k's centres."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in blocks_in(batches, dims):
            out = []
            for own in centres.values():
                distance = squares(x, own)
                labels = distance.argmin(1)
                out.append(block_sums(x, labels, distance[np.arange(len(x)), labels], len(own)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(centres), pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array(out, pa.binary())],
                names=["k", "block", "sums"])

    return collected(packed.mapInArrow(run, SUMS_SCHEMA), blocks, dims + 3)


def moved(centres: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The means of the clusters; an empty one keeps its centre."""
    counts = sums[:, :1]
    return np.where(counts > 0, sums[:, 3:] / np.maximum(counts, 1.0), centres)


def first_centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres drawn one by one by squared distance, the best of some draws each, then moved on these rows."""
    draw = np.random.default_rng([seed, k])
    centres = x[[draw.integers(len(x))]]
    nearest = squares(x, centres)[:, 0]
    while len(centres) < k:
        tries = 2 + int(np.log(k))
        if nearest.sum() > 0:
            chosen = np.searchsorted(np.cumsum(nearest), draw.random(tries) * nearest.sum(), "right")
            chosen = np.minimum(chosen, len(x) - 1)
        else:
            chosen = draw.integers(len(x), size=tries)
        reached = np.minimum(nearest[:, None], squares(x, x[chosen]))
        best = int(reached.sum(0).argmin())
        centres, nearest = np.vstack([centres, x[chosen[best]]]), reached[:, best]
    for _ in range(100):
        distance = squares(x, centres)
        labels = distance.argmin(1)
        after = moved(centres, block_sums(x, labels, distance[np.arange(len(x)), labels], k))
        if ((after - centres) ** 2).sum() <= SETTLED:
            return after
        centres = after
    return centres


def silhouettes(packed: DataFrame, centres: Centres, sums: dict[int, np.ndarray], dims: int, blocks: int) -> dict[int, float]:
    """Mean silhouette of every k by mean squared distances, from the clusters' sums and one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in blocks_in(batches, dims):
            length, rows, out = (x * x).sum(1), np.arange(len(x)), []
            for k, own in centres.items():
                labels = squares(x, own).argmin(1)
                count = sums[k][:, 0]
                apart = length[:, None] * count + sums[k][:, 2] - 2.0 * x @ sums[k][:, 3:].T
                with np.errstate(divide="ignore", invalid="ignore"):
                    inner = apart[rows, labels] / (count[labels] - 1)
                    mean = np.where(count > 0, apart / count, np.inf)
                    mean[rows, labels] = np.inf
                    outer = mean.min(1)
                    value = (outer - inner) / np.maximum(outer, inner)
                value[(count[labels] <= 1) | ~np.isfinite(outer) | ~np.isfinite(value)] = 0.0
                out.append(np.array([value.sum(), len(x)]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(centres), pa.int32()), pa.array([block] * len(out), pa.int64()), pa.array(out, pa.binary())],
                names=["k", "block", "sums"])

    found = collected(packed.mapInArrow(run, SUMS_SCHEMA), blocks, 2)
    return {k: float(value[0, 0] / value[0, 1]) for k, value in found.items()}


def start_rows(packed: DataFrame, dims: int, share: int) -> np.ndarray:
    """One in ``share`` of the rows, in order of their values.

    A hash of their numbers chooses them: of rows with equal values it takes a
    share as well, where a hash of the values would take all or none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, x in blocks_in(batches, dims):
            numbers = mix(np.uint64(block * BLOCK) + np.arange(len(x), dtype=np.uint64))
            chosen = np.ascontiguousarray(x[numbers % np.uint64(share) == 0])
            yield pa.RecordBatch.from_pydict({"body": [chosen.tobytes()]})

    with few_at_once(packed.sparkSession):
        bodies = packed.mapInArrow(run, "body binary").collect()  # about START_ROWS rows in all
    start = np.concatenate([np.empty((0, dims)), *[np.frombuffer(row["body"], "<f8").reshape(-1, dims) for row in bodies]])
    return start[np.lexsort(start.T[::-1])]


def sweep(rows: DataFrame, columns: Sequence[str], ks: Iterable[int], seed: int, iterations: int) -> list[tuple]:
    """(k, inertia, silhouette) for every k, over rows whose order within their parts is fixed.

    The first centres come from at most about ``START_ROWS`` rows, chosen by a
    hash of their numbers; all rows move them.
    """
    ks, dims = sorted(set(ks)), len(columns)
    packed = settle(pack_blocks(rows, columns), "blocks")
    blocks, size = packed.agg(F.count(F.lit(1)), F.sum(F.octet_length("body"))).first()
    share = max(1, -(-(size or 0) // (8 * dims) // START_ROWS))
    start = start_rows(packed, dims, share)
    if not len(start):
        raise ValueError("no rows to cluster")
    centres = {k: first_centres(start, k, seed) for k in ks}
    left = dict(centres)
    for _ in range(iterations):
        if not left:
            break
        for k, sums in scan(packed, left, dims, blocks).items():
            after = moved(left[k], sums)
            centres[k] = after
            if ((after - left[k]) ** 2).sum() <= SETTLED:
                del left[k]
            else:
                left[k] = after
    final = scan(packed, centres, dims, blocks)
    quality = silhouettes(packed, centres, final, dims, blocks)
    return [(k, float(final[k][:, 1].sum()), quality[k]) for k in ks]

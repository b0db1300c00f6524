"""Exact n-gram Jaccard join behind Bayesian pruning of MinHash candidates.

Documents with one set of word shingles form a class, and classes are numbered
once and joined through one of their documents. Classes meet in the bands of a MinHash
signature. Pairs in a band are compared a few signature values at a time and
dropped as soon as the posterior probability of reaching the threshold falls
below ``TOLERANCE``; what survives ties the classes into clusters. Inside a
cluster every pair is compared the same way, and what survives is verified on
the exact shingle sets. Pairs are counted where they are compared and never
written out, so a group of thousands of near copies costs its comparisons but
no quadratic table; buckets and clusters beyond ``TILE`` rows are split into
tiles of two blocks each.

Shares of loss: with 128 values in 32 bands of 4, a pair at exactly the
threshold 0.8 misses all bands with probability 5e-8; pruning loses at most
``TOLERANCE`` per look.

Defined cases: a text with 1 to 4 words is one shingle; a text without words
(null, empty, blank) links with nothing; rows with one id and one shingle set
are one document, and so are rows with a null id and one shingle set; rows with
one id and different sets are documents of their own; the component is the
smallest id in it that is not null, null if there is none; an empty table gives
no rows; extra columns are ignored by the join and kept by
``keep_one_per_group``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from georisk.llm import arrays
from georisk.llm.graph import components
from georisk.workspace import settle

VALUES, BAND = 128, 4
BANDS = VALUES // BAND
LOOKS = (16, 32, 64, 96, 128)
TOLERANCE = 1e-9
TILE = 512

SKETCH_SCHEMA = "id long, mark long, hi long, lo long, bands array<long>, sig binary"


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    numbers = arrays.mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64))
    words = (numbers >> np.uint64(32)).astype(np.uint32)
    return words[:VALUES] | np.uint32(1), words[VALUES:]


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (rows, VALUES) of sets of 64-bit hashes; empty rows hold the maximum."""
    rows = len(bounds) - 1
    out = np.full((rows, VALUES), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        words = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
        heads = bounds[:-1][full]
        scale, shift = _seeds()
        for j in range(VALUES):
            turned = (words ^ shift[j]) * scale[j]
            turned ^= turned >> np.uint32(15)
            out[full, j] = np.minimum.reduceat(turned * np.uint32(0x85EBCA6B), heads)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per row and band."""
    parts = sig.reshape(len(sig), BANDS, BAND).astype(np.uint64)
    key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(BAND):
        key = arrays.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.astype(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For each look, the matches below which a pair is dropped.

    With a uniform prior on the similarity, m matches of n leave
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    limits = []
    for n in LOOKS:
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        limits.append(m)
    return limits


def survivors(sig: np.ndarray, row: int, others: np.ndarray, limits: list[int]) -> np.ndarray:
    """Those of ``others`` that stay likely enough to reach the threshold with ``row``."""
    matches, before = np.zeros(len(others), np.int32), 0
    for n, limit in zip(LOOKS, limits):
        matches = matches + (sig[others, before:n] == sig[row, before:n]).sum(1)
        kept = matches >= limit
        if not kept.all():
            others, matches = others[kept], matches[kept]
        if not len(others):
            break
        before = n
    return others


def sketch(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, text hash, shingle set hash, bands, signature) of each document; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in arrays.slices(batch.column(2)):
                hashes, bounds = arrays.word_hashes(buf, offsets)
                values, at = arrays.distinct_sorted(*arrays.shingles(hashes, bounds, size))
                sig = signatures(values, at)
                full = np.diff(at) > 0
                raw = values.tobytes()
                sets = np.frombuffer(
                    b"".join(blake2b(raw[8 * a:8 * b], digest_size=16).digest()
                             for a, b in zip(at[:-1], at[1:])), "<i8").reshape(-1, 2)
                keys = band_keys(sig)[full]
                ends = np.concatenate(([0], np.cumsum(full * BANDS))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                    pa.array(sets[:, 0].copy(), mask=~full), pa.array(sets[:, 1].copy(), mask=~full),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1))),
                    arrays.binaries(sig.reshape(-1).astype(np.uint8), np.arange(last - first + 1) * VALUES),
                ], names=["id", "mark", "hi", "lo", "bands", "sig"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, SKETCH_SCHEMA)


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, text): a null text and an empty one have one mark."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), text_mark(text_col).alias("mark"), F.col(text_col).alias("text"))


def text_mark(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def in_tiles(rows: DataFrame, group: str, member: str, size: str) -> DataFrame:
    """Rows once for each tile they belong to: columns ``ti`` and ``tj`` number the tile's blocks.

    A group of at most TILE rows is one tile; a larger one is cut into blocks by
    a hash of the member, and each pair of blocks is a tile. A tile holds about
    2 * TILE rows however large the group is.
    """
    blocks = F.ceil(F.col(size) / F.lit(TILE))
    own = F.pmod(F.xxhash64(member), blocks)
    cut = rows.withColumn("__n", blocks).withColumn("__own", own)
    cut = cut.withColumn("__other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)))
    return cut.withColumn("ti", F.least("__own", "__other")).withColumn(
        "tj", F.greatest("__own", "__other")).drop("__n", "__other")


class Forest:
    """Union-find over a few rows."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _sorted_runs(columns: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal keys in sorted columns, and the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), n)


def by_tile(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole tiles of a stream sorted by ``keys``; a tile may span batches."""
    left: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        table = pa.concat_tables([*left, table]).combine_chunks() if left else table
        ends = _sorted_runs([table.column(k).to_numpy() for k in keys])
        for a, b in zip(ends[:-2], ends[1:-1]):
            yield table.slice(a, b - a)
        left = [table.slice(ends[-2])]
    yield from left


def link_candidates(tile: pa.Table, limits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its part): the parts of a tile that survivors tie together."""
    ids = tile.column("rep").to_numpy()
    sig = np.frombuffer(b"".join(tile.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
    order = np.argsort(ids, kind="stable")
    waiting, parts, leaders = order, np.arange(len(ids)), ids.copy()
    while len(waiting):
        seed, waiting = waiting[0], waiting[1:]
        queue = [seed]
        while queue and len(waiting):
            found = survivors(sig, queue.pop(), waiting, limits)
            if len(found):
                leaders[found] = ids[seed]
                parts[found] = seed
                waiting = waiting[~np.isin(waiting, found)]
                queue.extend(found)
    tied = leaders != ids
    return ids[tied], leaders[tied]


def candidate_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that tie the classes of every likely pair into one cluster."""
    limits = least_matches(threshold, TOLERANCE)
    slots = classes.select("rep", F.explode("bands").alias("bucket"))
    crowded = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = slots.join(crowded, "bucket").join(classes.select("rep", "sig"), "rep")
    tiles = in_tiles(met, "bucket", "rep", "size").select("bucket", "ti", "tj", "rep", "sig")
    keys = ["bucket", "ti", "tj"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in by_tile(batches, keys):
            a, b = link_candidates(tile, limits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    placed = tiles.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, "a long, b long").distinct()


def count_links(
    tile: pa.Table, threshold: tuple[int, int], limits: list[int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members, linked documents of each in the tile, and the smallest member they reach.

    In a tile of two blocks only pairs across the blocks count; pairs within a
    block belong to the block's own tile. Repeated rows of a document count once.
    """
    tile = tile.sort_by([("rep", "ascending"), ("hi", "ascending"), ("lo", "ascending")])
    tile = tile.take(_sorted_runs([tile.column(k).to_numpy() for k in ("rep", "hi", "lo")])[:-1])
    ids, weight = tile.column("rep").to_numpy(), tile.column("copies").to_numpy()
    blocks = tile.column("__own").to_numpy()
    across = tile.column("ti")[0].as_py() != tile.column("tj")[0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in tile.column("values").to_pylist()]
    lengths = np.array([len(x) for x in sets], np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    sig = signatures(flat, bounds)
    _, local = np.unique(flat, return_inverse=True)
    local = local.reshape(-1)
    marks = np.zeros(int(local.max()) + 1 if len(local) else 1, np.int64)
    high, low = threshold
    n, linked, forest = len(ids), np.zeros(len(ids), np.int64), Forest(len(ids))
    for row in range(n):
        rest = np.arange(row + 1, n)
        if across:
            rest = rest[blocks[rest] != blocks[row]]
        small, large = np.minimum(lengths[row], lengths[rest]), np.maximum(lengths[row], lengths[rest])
        rest = survivors(sig, row, rest[low * small >= high * large], limits)
        if not len(rest):
            continue
        own = local[bounds[row]:bounds[row + 1]]
        marks[own] = 1
        picks = np.repeat(bounds[rest] - np.concatenate(([0], np.cumsum(lengths[rest])[:-1])), lengths[rest])
        picks += np.arange(len(picks))
        heads = np.concatenate(([0], np.cumsum(lengths[rest])[:-1]))
        shared = np.add.reduceat(marks[local[picks]], heads)
        marks[own] = 0
        union = lengths[row] + lengths[rest] - shared
        rest = rest[low * shared >= high * union]
        linked[row] += weight[rest].sum()
        linked[rest] += weight[row]
        for other in rest:
            forest.join(row, int(other))
    roots = ids[[forest.root(x) for x in range(n)]] if n else ids
    return ids, linked, roots


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``wanted`` (rep, first_id, first_mark, ...) with the sorted distinct shingles of a document of each class."""
    texts = texts_of(docs, id_col, text_col)
    known = wanted.where("first_id IS NOT NULL").withColumnRenamed("first_id", "id")
    rows = texts.drop("mark").join(known, "id").drop("id", "first_mark")
    # Classes of null ids only: by the text, one row of each.
    nameless = wanted.where("first_id IS NULL").withColumnRenamed("first_mark", "mark")
    rows = rows.unionByName(
        texts.where("id IS NULL").drop("id").dropDuplicates(["mark"]).join(nameless, "mark").drop("mark", "first_id"))
    names = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text") + ", hi2 long, lo2 long, values binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in arrays.slices(batch.column("text")):
                hashes, bounds = arrays.word_hashes(buf, offsets)
                values, at = arrays.distinct_sorted(*arrays.shingles(hashes, bounds, size))
                raw = values.tobytes()
                sets = np.frombuffer(
                    b"".join(blake2b(raw[8 * a:8 * b], digest_size=16).digest()
                             for a, b in zip(at[:-1], at[1:])), "<i8").reshape(-1, 2)
                part = [batch.column(n).slice(first, last - first) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*part, pa.array(sets[:, 0].copy()), pa.array(sets[:, 1].copy()),
                     arrays.binaries(values, at)], names=[*names, "hi2", "lo2", "values"])

    return rows.mapInArrow(run, schema)


def linked_classes(
    docs: DataFrame, id_col: str, text_col: str, size: int, threshold: tuple[int, int]
) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and (hi, lo, rep, first_id, copies, linked, component) of their classes.

    ``component`` is the number of a class that stands for all classes that
    links reach from ``rep``; it is null for a class that links with no other.
    """
    high, low = threshold
    limits = least_matches(high / low, TOLERANCE)
    sketches = settle(sketch(docs, id_col, text_col, size), "sketches")
    worded = sketches.where("hi is not null")
    members = worded.groupBy("id", "hi", "lo").agg(F.min("mark").alias("mark"))
    sets = settle(members.groupBy("hi", "lo").agg(
        F.min("id").alias("first_id"), F.min("mark").alias("first_mark"), F.count(F.lit(1)).alias("copies")).withColumn(
        "rep", F.monotonically_increasing_id()), "classes")
    # The signature of a class is that of any of its rows: one row of its smallest document.
    own = worded.join(sets, ["hi", "lo"]).where(F.col("id").eqNullSafe(F.col("first_id")))
    classes = settle(own.dropDuplicates(["rep"]).select(
        "rep", "hi", "lo", "first_id", "first_mark", "copies", "bands", "sig"), "class_rows")

    ties = components(candidate_links(classes, high / low), "a", "b")
    ties = settle(ties.withColumnRenamed("id", "rep"), "ties")
    sizes = ties.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    wanted = ties.join(sizes, "component").join(classes.drop("bands", "sig"), "rep")
    rows = shingle_sets(docs, wanted, id_col, text_col, size).where("hi = hi2 and lo = lo2").drop("hi2", "lo2")
    keys = ["component", "ti", "tj"]
    tiles = in_tiles(rows, "component", "rep", "size").drop("size").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in by_tile(batches, keys):
            ids, linked, roots = count_links(tile, (high, low), limits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(linked), pa.array(roots)], names=["rep", "linked", "root"])

    found = settle(tiles.mapInArrow(run, "rep long, linked long, root long"), "tile_links")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    reached = components(found, "rep", "root").withColumnRenamed("id", "rep")
    # Facts meet the classes first, one row each, and then the documents of a class.
    return sketches, settle(sets.join(linked.join(reached, "rep", "left"), "rep", "left"), "class_facts")


def jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
    threshold: tuple[int, int] = (4, 5),
) -> DataFrame:
    """One row per document: ``class_id``, ``n_links``, ``component_id`` and ``kept``.

    ``class_id`` is the smallest id with the same shingle set (null without
    words), ``n_links`` the number of other documents at a Jaccard similarity
    of at least ``threshold`` (a fraction), ``component_id`` the smallest id
    reachable by links, itself included, and ``kept`` marks that document.
    """
    sketches, facts = linked_classes(docs, id_col, text_col, size, threshold)
    least = facts.where("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least_id"))
    facts = facts.join(least, "component", "left").select(
        "hi", "lo", F.col("first_id").alias("class_id"),
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"))
    members = sketches.where("hi is not null").select("id", "hi", "lo").distinct()
    rows = members.join(facts, ["hi", "lo"]).drop("hi", "lo")
    blank = sketches.where("hi is null").select("id").distinct().select(
        "id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"))
    out = rows.unionByName(blank)
    return out.select(
        F.col("id").alias(id_col), "class_id", "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: tuple[int, int] = (4, 5)
) -> DataFrame:
    """One document of each group of linked or equal texts; columns unchanged.

    It is the one with the smallest id, null last, and of several texts of that
    id the one with the smallest hash; of rows that agree in id and text one
    stays. Rows without words stay. Nothing else goes: a row whose text is like
    no other stays whatever its id.
    """
    sketches, facts = linked_classes(docs, id_col, text_col, size, threshold)
    group = F.coalesce("component", "rep").alias("group")
    rows = sketches.where("hi IS NOT NULL").join(facts, ["hi", "lo"]).select(group, "id", "mark")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "mark")).alias("first")
    kept = rows.groupBy("group").agg(first).select(F.col("first.id").alias("__id"), F.col("first.mark").alias("__mark"))
    blank = sketches.where("hi IS NULL").select(F.col("id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    names = docs.columns
    marked = docs.withColumns({"__id": F.col(id_col).cast("long"), "__mark": text_mark(text_col)})

    def among(chosen: DataFrame) -> DataFrame:
        same = (marked["__mark"] == chosen["__mark"]) & marked["__id"].eqNullSafe(chosen["__id"])
        return marked.join(chosen, same, "left_semi")

    return among(kept).dropDuplicates(["__id", "__mark"]).unionByName(among(blank)).select(*names)

"""Mixing sources to target weights with blocks drawn by multinomial counts.

Words of a source are packed into fixed-length blocks. Each source has as many
slots as its target asks for, and output shards draw how many of them they take
from each source: a multinomial draw given these totals (a multivariate
hypergeometric one), so that shards vary as in a free draw and the mix as a whole
stays on target. A source's slots are numbered
through all shards, and a pseudorandom permutation of the source's block
indexes, another one for each pass, maps slot numbers to blocks. Slots join
blocks by index, and blocks know which words of which documents they hold.

Defined cases: a null text has no words; a null source is a source, the last in
order; a null or repeated ``doc_id`` is allowed, as rows are mixed one by one
(``mix_texts``: rows that share id, source and size share their passages);
sources without words take nothing; an empty table gives no rows; extra columns
are ignored by ``mix_plan`` and kept by ``mix_texts``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from georisk.llm import arrays
from georisk.workspace import settle

BLOCK_WORDS = 64
SHARD_SLOTS, MOST_SHARDS, PART_SLOTS = 4096, 1 << 16, 1 << 17
# Words packed in one run, and the bound on the number of runs of all sources.
RUN_WORDS, MOST_RUNS = 1 << 16, 1 << 20
MOST_PASSES = 3


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.diff(arrays.words(buf, offsets)[2])
                     for _, _, buf, offsets in arrays.slices(batch.column(2))]
            size = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size.astype(np.int64))],
                names=["doc_id", "source", "size"])

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, source string, size long")


def targets(sizes: Sequence[int], weights: Sequence[float], most: int = MOST_PASSES) -> list[float]:
    """Shares of the whole size by weight, none above ``most`` times its source.

    What a source can't take is shared again by weight among the others.
    """
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def permuted(index: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of range(size): a Feistel network, walked until inside."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), arrays.mix(np.arange(4, dtype=np.uint64) + np.uint64(seed * 8))

    def turn(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            left, right = right, left ^ (arrays.mix(right + key) & mask)
        return (left << np.uint64(half)) | right

    out = turn(index.astype(np.uint64))
    outside = out >= size
    while outside.any():
        out[outside] = turn(out[outside])
        outside = out >= size
    return out.astype(np.int64)


def block_table(sized: DataFrame, facts: list[dict]) -> tuple[DataFrame, DataFrame]:
    """(rid, src, block, at, words): the words of rows that blocks hold; and blocks per source.

    Rows of a source are dealt to runs by hash, each run is packed by itself and
    starts a new block. Runs hold about RUN_WORDS words, more only in tables
    with over MOST_RUNS runs, so no task gets a whole source and the table of
    runs, which is summed up per source, has a bounded number of rows.
    """
    spark = sized.sparkSession
    total = sum(f["size"] for f in facts)
    unit = max(RUN_WORDS, -(-total // MOST_RUNS))
    known = spark.createDataFrame(
        [(f["source"], f["src"], max(1, -(-f["size"] // unit))) for f in facts],
        "source string, src long, runs long")
    rows = sized.where("size > 0").join(
        F.broadcast(known), sized["source"].eqNullSafe(known["source"])).select(
        "rid", "doc_id", "size", "src", F.pmod(F.xxhash64(F.coalesce("doc_id", "rid"), "size"), "runs").alias("run"))
    order = Window.partitionBy("src", "run").orderBy("doc_id", "size", "rid")
    rows = settle(rows.withColumn("first", F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")), "runs")
    runs = rows.groupBy("src", "run").agg(
        F.ceil(F.max(F.col("first") + F.col("size")) / F.lit(BLOCK_WORDS)).alias("n"))
    before = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    runs = settle(runs.withColumn("base", F.sum("n").over(before) - F.col("n")), "run_blocks")
    length = F.lit(BLOCK_WORDS)
    parts = rows.join(runs, ["src", "run"]).select(
        "rid", "src", "base", "first", "size", F.explode(F.sequence(
            F.floor(F.col("first") / length),
            F.floor((F.col("first") + F.col("size") - 1) / length))).alias("b"))
    begin = F.greatest(F.col("b") * length - F.col("first"), F.lit(0))
    end = F.least((F.col("b") + 1) * length - F.col("first"), F.col("size"))
    held = parts.select(
        "rid", "src", (F.col("base") + F.col("b")).alias("block"), begin.alias("at"),
        (end - begin).alias("words"))
    return held, runs.groupBy("src").agg(F.sum("n").alias("blocks"))


def whole_slots(goals: np.ndarray, slots: int) -> np.ndarray:
    """Whole numbers that sum to ``slots``, each within one of its share."""
    exact = goals / goals.sum() * slots
    counts = np.floor(exact + 1e-9).astype(np.int64)
    rest = np.argsort(counts - exact, kind="stable")[:slots - int(counts.sum())]
    counts[rest] += 1
    return counts


def draw_part(counts: np.ndarray, size: int, draw: np.random.Generator) -> np.ndarray:
    """How many of ``size`` slots drawn without replacement fall to each source."""
    out, left = np.zeros(len(counts), np.int64), int(counts.sum())
    for i, own in enumerate(counts.tolist()):
        other = left - own
        if left < 10**9:
            taken = int(draw.hypergeometric(own, other, size)) if size else 0
        else:
            # The same mean and variance, beyond the numbers that the exact draw takes.
            mean = size * own / left
            spread = math.sqrt(max(0.0, mean * other / left * (left - size) / (left - 1)))
            taken = min(max(round(mean + spread * draw.standard_normal()), size - other, 0), own, size)
        out[i], size, left = taken, size - taken, other
    return out


def shard_counts(totals: np.ndarray, per: int, shards: int, shard: int, seed: int) -> np.ndarray:
    """Slots of each source in one shard: the totals are halved, each half by its own draw, down to the shard."""
    slots, counts, low, high = int(totals.sum()), totals, 0, shards
    while high - low > 1:
        middle = (low + high) // 2
        left = draw_part(counts, min(middle * per, slots) - low * per, np.random.default_rng([seed, low, high]))
        low, high, counts = (low, middle, left) if shard < middle else (middle, high, counts - left)
    return counts


def draw_slots(spark, facts: list[dict], total: int, seed: int) -> DataFrame:
    """(src, block, times): how often the mix takes each block that it takes.

    ``facts`` have ``src``, ``target`` and ``blocks`` of each source.
    """
    slots = max(1, round(total / BLOCK_WORDS))
    per = max(SHARD_SLOTS, -(-slots // MOST_SHARDS))
    shards = -(-slots // per)
    totals = whole_slots(np.array([f["target"] for f in facts]), slots)
    blocks = {f["src"]: f["blocks"] for f in facts}
    ids = [f["src"] for f in facts]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts = shard_counts(totals, per, shards, shard, seed)
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard] * len(ids), pa.int64()), pa.array(ids, pa.int64()),
                    pa.array(counts)], names=["shard", "src", "n"])

    drawn = spark.range(shards).mapInArrow(draw, "shard long, src long, n long").where("n > 0")
    # At most MOST_SHARDS rows per source.
    before = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    # Few small rows that become many: the number of parts follows the slots they stand for.
    numbered = drawn.withColumn("first", F.sum("n").over(before) - F.col("n")).repartition(
        -(-slots // PART_SLOTS), "shard", "src")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for src, first, n in zip(*(batch.column(c).to_pylist() for c in ("src", "first", "n"))):
                count = blocks[src]
                for begin in range(first, first + n, 1 << 16):
                    slot = np.arange(begin, min(begin + (1 << 16), first + n, MOST_PASSES * count))
                    passes = slot // count
                    for turn in np.unique(passes):
                        at = permuted(slot[passes == turn] % count, count, seed * 65537 + src * 11 + int(turn))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), src, np.int64)), pa.array(at)], names=["src", "block"])

    return numbered.mapInArrow(place, "src long, block long").groupBy("src", "block").agg(
        F.count(F.lit(1)).alias("times"))


def _plan(
    docs: DataFrame, weights: Sequence[float], seed: int, id_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, list[dict], DataFrame | None]:
    """Sized rows with a row number, facts per source, and the taken parts (rid, at, words, times)."""
    spark = docs.sparkSession
    sized = settle(word_counts(docs, id_col, text_col, source_col).withColumn(
        "rid", F.monotonically_increasing_id()), "sized")
    # One row per source; strings compare by code point.
    found = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(
        F.sum("size").alias("size")).orderBy(F.col("source").asc_nulls_last()).collect()]
    sizes = [size for _, size in found]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(found))])
    facts = [{"source": s, "src": i, "size": size, "target": goal[i]} for i, (s, size) in enumerate(found)]
    total = sum(sizes)
    if not total:
        return sized, facts, None
    held, blocks = block_table(sized, [f for f in facts if f["size"]])
    count = {r["src"]: r["blocks"] for r in blocks.collect()}
    drawn = draw_slots(spark, [f | {"blocks": count[f["src"]]} for f in facts if f["size"]], total, seed)
    # The drawn blocks grow with the corpus, which the planner can't see behind the draw.
    return sized, facts, held.join(drawn.hint("merge"), ["src", "block"]).select("rid", "at", "words", "times")


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``size``, ``source_size``, ``target`` and ``taken`` words of every document.

    Sources in code point order, null last, have the ``weights`` in turn.
    """
    sized, facts, taken = _plan(docs, weights, seed, id_col, text_col, source_col)
    known = docs.sparkSession.createDataFrame(
        [(f["source"], f["size"], f["target"]) for f in facts],
        "__source string, source_size long, target double")
    rows = sized.join(F.broadcast(known), sized["source"].eqNullSafe(known["__source"]))
    if taken is None:
        rows = rows.withColumn("taken", F.lit(0).cast("long"))
    else:
        rows = rows.join(taken.groupBy("rid").agg(F.sum(F.col("words") * F.col("times")).alias("taken")), "rid", "left")
    return rows.select(
        F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_texts(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixed corpus: ``docs`` with the texts of the words that the mix takes.

    The passages of one pass follow each other as in the document, joined by a
    space where the mix left words out; passes are joined by an empty line.
    Documents of which nothing is taken are left out, those without words too.
    """
    sized, _, taken = _plan(docs, weights, seed, id_col, text_col, source_col)
    if taken is None:
        return docs.limit(0)
    spans = taken.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", "words", "times"))).alias("__spans"))
    plans = spans.join(sized, "rid").groupBy("doc_id", "source", "size").agg(
        F.min_by("__spans", "rid").alias("__spans")).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "__spans")
    names = docs.columns
    ids = F.col(id_col).cast("long")
    rows = docs.join(plans, ids.eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = [], []
            spans, sizes = batch.column("__spans").to_pylist(), batch.column("__size").to_pylist()
            row = 0
            for _, _, buf, offsets in arrays.slices(batch.column(text_col)):
                starts, ends, bounds = arrays.words(buf, offsets)
                for i in range(len(offsets) - 1):
                    if bounds[i + 1] - bounds[i] == sizes[row]:
                        kept.append(row)
                        texts.append(taken_text(buf, starts[bounds[i]:bounds[i + 1]], ends[bounds[i]:bounds[i + 1]], spans[row]))
                    row += 1
            part = batch.take(pa.array(kept, pa.int64()))
            columns = {name: part.column(name) for name in names}
            columns[text_col] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return rows.mapInArrow(cut, docs.schema)


def taken_text(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, spans: list[dict]) -> bytes:
    passes = []
    for turn in range(max(span["times"] for span in spans)):
        runs: list[list[int]] = []
        for span in spans:
            if span["times"] > turn:
                a, b = span["at"], span["at"] + span["words"]
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        passes.append(b" ".join(buf[starts[a]:ends[b - 1]].tobytes() for a, b in runs))
    return b"\n\n".join(passes)

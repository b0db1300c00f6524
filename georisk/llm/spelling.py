"""Spelling variants: words that differ by one inserted, deleted or replaced letter.

Two words differ by a single edit if their common prefix and common suffix
together reach the longer length minus one. Which pairs are compared follows
from the same fact: let the longer word have M code points and the common
prefix p of them, 0 <= p < M. For any range [a, b) that holds p, both words
start with the same a code points and end with the same M - b. So a word enters
one group per range of a partition of [0, M), keyed by those two ends, once for
its own length and once for the next one, and every pair meets in exactly one
group. Groups that are too large are split by halving their range; at a range of
one place a group holds at most one word for each letter and one shorter word,
so no group is left large and no pair is lost.

Rows of many groups lie sorted in blocks; blocks that share a group are compared
as padded code-point matrices. Only counts and the best neighbour of each word
leave a task, never pairs.

Defined cases: a null or empty text has no words; a null id is the text before
the colon left empty; repeated rows count as often as they occur; ties of count
go to the smaller word in code-point order; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from georisk.workspace import settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Words a task counts before it hands them on; words of a group that are compared without
# splitting it; rows of a block; rows of a part; code points of the matrices held at once.
COUNTED, GROUP, BLOCK, PART_ROWS, CELLS = 400_000, 128, 64, 100_000, 1 << 19
NODE = ("m", "a", "b", "ends")
FOUND_SCHEMA = "word string, near long, best_n long, best string"


def altered(run: str, start: int, every: int) -> str:
    """The run, or the run less one code point where its checksum says so."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_col: str, text_col: str, least: int, every: int) -> DataFrame:
    """(word, n) for every word of at least ``least`` code points, counted per task."""

    def hand_on(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                # Lower-casing the bytes changes A-Z only.
                plain = (text.as_py() or "").encode().lower().decode()
                key = key.as_py()
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(RUN.findall(plain)).items():
                    if len(word) >= least:
                        word = altered(word, start, every)
                        if len(word) >= least:
                            counts[word] += n
                if len(counts) >= COUNTED:
                    yield hand_on(counts)
                    counts = Counter()
        yield hand_on(counts)

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def keyed(rows: DataFrame, ranges: Column) -> DataFrame:
    """One row per word and range, with the two ends that all words of the group share."""
    nodes = rows.select("word", "n", F.explode(ranges).alias("node")).select("word", "n", "node.*")
    tail = F.expr("right(word, m - b)")
    return nodes.withColumn("ends", F.concat(F.expr("left(word, a)"), F.lit("|"), tail))


def node(m: Column, a: Column, b: Column) -> Column:
    return F.struct(m.cast("int").alias("m"), a.cast("int").alias("a"), b.cast("int").alias("b"))


def first_ranges() -> Column:
    """Quarters of [0, M) for M the length of the word and the next one."""
    size = F.char_length("word")
    out = []
    for m in (size, size + 1):
        marks = [F.floor(m * i / 4) for i in range(5)]
        out += [node(m, low, high) for low, high in zip(marks, marks[1:])]
    return F.array(*out)


def halves() -> Column:
    m, a, b = (F.col(name) for name in "mab")
    middle = F.floor((a + b) / 2)
    return F.array(node(m, a, middle), node(m, middle, b))


def padded(words: list[bytes], width: int) -> np.ndarray:
    """A row of code points per word, zeros after its end."""
    return np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For tiles of rows: how many first columns agree, for every pair of rows of a tile."""
    tiles, rows, width = left.shape
    alive = np.ones((tiles, rows, right.shape[1]), bool)
    agreed = np.zeros(alive.shape, np.int32)
    for c in range(width):
        alive &= left[:, :, None, c] == right[:, None, :, c]
        if not alive.any():
            break
        agreed += alive
    return agreed


def tile_links(
    words: list[bytes], group: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group that differ by a single edit inside the group's range."""
    size = np.fromiter(map(len, words), np.int64)
    order = np.arange(0, len(words), BLOCK)
    last = np.minimum(order + BLOCK, len(words)) - 1
    # Block y meets block x if x ends in the group that y starts in.
    until = np.searchsorted(group[order], group[last], "right")
    x = np.repeat(np.arange(len(order)), until - np.arange(len(order)))
    y = np.concatenate([np.arange(i, j) for i, j in enumerate(until)])
    backward = [word[::-1] for word in words]
    widest = np.maximum.reduceat(size, order)
    first = 0
    while first < len(x):
        width, stop = int(max(widest[x[first]], widest[y[first]])), first + 1
        while stop < len(x) and (stop - first + 1) * BLOCK * max(BLOCK, width) <= CELLS:
            width = max(width, int(widest[x[stop]]), int(widest[y[stop]]))
            stop += 1
        lanes = np.arange(BLOCK)
        i, j = order[x[first:stop], None] + lanes, order[y[first:stop], None] + lanes
        inside = (i < len(words))[:, :, None] & (j < len(words))[:, None, :] & (i[:, :, None] < j[:, None, :])
        i, j = np.minimum(i, len(words) - 1), np.minimum(j, len(words) - 1)
        inside &= group[i][:, :, None] == group[j][:, None, :]

        def block(texts: list[bytes], at: np.ndarray) -> np.ndarray:
            return padded([texts[k] for k in at.ravel()], width).reshape(*at.shape, width)

        shorter = np.minimum(size[i][:, :, None], size[j][:, None, :])
        longer = np.maximum(size[i][:, :, None], size[j][:, None, :])
        prefix = np.minimum(agreement(block(words, i), block(words, j)), shorter)
        suffix = np.minimum(agreement(block(backward, i), block(backward, j)), shorter)
        near = inside & (longer == m[i][:, :, None]) & (prefix < longer) & (prefix + suffix >= longer - 1)
        near &= (prefix >= a[i][:, :, None]) & (prefix < b[i][:, :, None])
        tile, row, column = np.nonzero(near)
        yield i[tile, row], j[tile, column]
        first = stop


def compare_part(table: pa.Table) -> pa.Table:
    """For each word of the part's groups: near words and the best of them."""
    table = table.sort_by([(name, "ascending") for name in NODE])
    m, a, b, n = (table.column(name).to_numpy() for name in ("m", "a", "b", "n"))
    new = np.zeros(len(n), bool)
    for name in NODE:
        column = table.column(name).combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(n) - 1)).to_numpy(zero_copy_only=False)
    texts = table.column("word").to_pylist()
    words = [text.encode("latin-1") for text in texts]
    # Letters up to U+00FF sort by code point as their latin-1 bytes do.
    by_rank = np.array(sorted(range(len(n)), key=lambda k: (-n[k], words[k])), np.int64)
    rank = np.empty(len(n), np.int64)
    rank[by_rank] = np.arange(len(n))
    near, best = np.zeros(len(n), np.int64), np.full(len(n), len(n), np.int64)
    for i, j in tile_links(words, np.cumsum(new), m, a, b):
        for one, other in ((i, j), (j, i)):
            near += np.bincount(one, minlength=len(n))
            np.minimum.at(best, one, rank[other])
    hit = np.flatnonzero(near)
    other = by_rank[best[hit]]
    return pa.table({
        "word": pa.array([texts[k] for k in hit], pa.string()), "near": pa.array(near[hit]),
        "best_n": pa.array(n[other]), "best": pa.array([texts[k] for k in other], pa.string())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of each word of ``words`` (word, n) that has near words."""
    level = keyed(words, first_ranges())
    parts: list[DataFrame] = []
    while True:
        sizes = settle(level.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("size"), F.count_if(F.char_length("word") == F.col("m")).alias("longest"))
            .where("size > 1 AND longest > 0"), "groups")
        large = (F.col("size") > GROUP) & (F.col("b") - F.col("a") > 1)
        rows, wide = sizes.agg(F.sum(F.when(~large, F.col("size"))), F.count_if(large)).first()
        if rows:
            part = F.pmod(F.xxhash64(*NODE), F.lit(-(-rows // PART_ROWS))).alias("part")
            asked = level.join(sizes.where(~large).select(*NODE), list(NODE))
            parts.append(asked.select("word", "n", *NODE, part).groupBy("part").applyInArrow(compare_part, FOUND_SCHEMA))
        if not wide:
            break
        level = settle(keyed(level.join(sizes.where(large).select(*NODE), list(NODE)), halves()), "split")
    if not parts:
        return words.sparkSession.createDataFrame([], "word string, n_near long, best_n long, best string")
    found = parts[0]
    for more in parts[1:]:
        found = found.union(more)
    first = F.min(F.struct((-F.col("best_n")).alias("rank"), F.col("best")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.rank")).alias("best_n"), "first.best")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to their end.

    Every step doubles the way a word has gone. A form occurs at least twice as
    often as its word, so the ways have no loops and are short.
    """
    gone = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = gone.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = settle(gone.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        gone = step.select("word", "root")
        if step.where("moved").isEmpty():
            return gone


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: int = 5, min_count: int = 3, every: int = 97, ratio: int = 2,
) -> DataFrame:
    """Each word with its ``form``, ``root``, count ``n``, ``n_near`` and ``form_n``.

    Words are runs of letters, A-Z lower-cased, of at least ``least`` code
    points and with at least ``min_count`` occurrences; a run whose checksum
    with its document ``every`` divides has lost one code point. A word's form
    is its most frequent near word, if that is ``ratio`` times as frequent.
    """
    words = settle(count_words(docs, id_col, text_col, least, every).where(F.col("n") >= min_count), "words")
    near = near_words(words)
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    rated = settle(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    roots = last_forms(rated.where("form IS NOT NULL").select("word", "form"))
    return rated.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

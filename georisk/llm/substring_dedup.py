"""Fuzzy passages that repeat across documents, by collinear chaining of shared seeds.

Seeds are minimizers: of four runs of ``SEED_WORDS`` words in a row, the one
with the least hash. Documents are packed into segments, and a segment first
sends four bytes for each of its seeds; seeds of one document end there. The
others link each holder to the one before it, in the order of ids, and to the
first one, so a passage in a third of all documents gives at most twice as many
links as it has copies and not their square, and later copies meet one another. Where seeds in a row are all shared,
sequences of them, and all of them within nearly ``least_words`` words, are seeds
as well: they lead past documents that hold only a part of a passage. Seeds with more than ``HOT`` holders are linked in parts, and the parts
by their first holders.

These links are a first round. What its passages leave uncovered is open, and
each open seed asks all earlier holders in a second round (``rest_rows``,
``rest_part``): two holders are linked if within ``MARGIN`` words both hold a
second shared seed on the same side, ``REST_SPAN`` words from end to end or more,
and one of the two seeds is open. They meet by both seeds, at the rarer one of the
two, so holders with one frequent seed in common are not compared. Holders whose
words are equal for ``MARGIN`` words on both sides are one text: the first of them
is asked and asks, the others are linked to it. A run that says one phrase of up to
``WINDOW`` words over and over has a second seed in every other such run; it is
linked to the longest earlier one only, which has all that the others have
(``run_links``). Chains that the first round leaves out for a stronger one are
aligned too if they have open words.

Linked seeds of two documents are chained in order with gap costs; the best
predecessor of a run comes from a Fenwick tree over the places in the first
document. Around a chain both documents are read again: there every run of
``SEED_WORDS`` words is a seed, and the chains of these are extended, aligned
word by word, and reported if they are long and similar enough; a chain that is
not is parted at its widest gap.

So each passage has a source, and not every earlier one: those of words that are
covered already are not asked again. A fuzzy passage is missed if the seeds left of
it span fewer than ``LEAST_SPAN`` words (``REST_SPAN`` if neither the nearest nor the
first holder has it); the tests state the share that is found.
Where a text says one phrase over and over for longer than the source does, the
part beyond whole turns of the source may be left out.

Defined cases: null, empty and short texts have no seeds; a null ``doc_id``
takes no part; rows with one id and one text are one document; rows with one id
and different texts are documents of their own and never each other's source; a
passage that repeats only inside its own document is not reported; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from georisk.llm import arrays
from georisk.llm.ngram_join import _sorted_runs
from georisk.llm.suffix_dedup import numbers, packed, rows_of, segments, unpacked
from georisk.workspace import discard, settle

SEED_WORDS, WINDOW = 4, 4
# Seeds in a row that make a longer one; words by which runs of a chain may overlap.
SEQUENCE, SLACK = 6, 3
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LEAST_WORDS, LEAST_IDENTITY = 50, 0.8
LEAST_SEEDS, LEAST_SPAN = 2, 12
# Words that two seeds of the second round span; holders beyond which a seed has some that the first round does not link.
REST_SPAN, LINKED = 25, 3
# Cost of a skipped word in a chain of all runs, and of those that sampled seeds make.
GAP_COST, WIDE_COST = 0.1, 0.03
MARGIN, DROP = 64, 8
# Seeds of a bucket, holders of a seed that are linked in one row of holders, packed rows that a
# task hands on at once, seeds of a part, and the words (as a power of two) of a document whose
# links are chained together: chains across their ends are found from both sides.
BUCKET, HOT, HANDED, PART_SEEDS, STRETCH = 1 << 19, 4096, 1 << 18, 1 << 19, 16
# Holders of a seed that are compared at once with those of other seeds, and rows of a tile beyond.
SMALL, TILE = 64, 1024
# Links that are joined at once, and words of pairs of spans that are compared at once.
CHAINED, ALIGNED = 1 << 16, 1 << 16

_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNSTEP = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

KEY_SCHEMA = "bucket long, segment long, keys binary, counts binary"
HIT_SCHEMA = "segment long, bucket long, hits binary, totals binary"
# Rows that travel packed, many for one part: seeds with their places, and links of two places.
SEED_FIELDS = ("seed", "salt", "id", "tie", "segment", "row", "place", "words")
REST_FIELDS = ("seed", "id", "tie", "segment", "row", "place", "context", "many")
# Of a run: its period, its words from ``place`` on, and the first and the end of those that are open.
RUN_FIELDS = ("seed", "id", "tie", "segment", "row", "place", "period", "words", "first", "end")
LINK_FIELDS = ("id", "segment", "row", "source", "source_segment", "source_row", "x", "y", "words")
PACK_SCHEMA = "kind int, part long, body binary"
LINK, LEADER, RUN = 0, 1, 2
CHAIN_SCHEMA = (
    "id long, segment long, row int, source long, source_segment long, source_row int, "
    "x int, x_end int, y int, y_end int")
CHAIN_COLUMNS = [part.split()[0] for part in CHAIN_SCHEMA.split(", ")]
PASSAGE_SCHEMA = (
    "segment long, row int, doc_id long, start_word long, n_words long, source_doc_id long, source_start long, "
    "source_words long, matched long, identity double")


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; sorting is cheaper than the hash table of ``np.unique``."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[:len(values)]]


def least_of(values: np.ndarray, size: int, rows: np.ndarray) -> np.ndarray:
    """Places of the least of each ``size`` values in a row, if they are of one row; the first on ties."""
    if len(values) < size:
        return np.empty(0, np.int64)
    many = len(values) - size + 1
    begin = np.flatnonzero(rows[size - 1:] == rows[:many])
    best, steps = values[:many].copy(), np.zeros(many, np.int8)
    for step in range(1, size):
        steps[values[step:step + many] < best] = step
        np.minimum(best, values[step:step + many], out=best)
    # The place of the first least value never goes back.
    least = begin + steps[begin]
    return least[np.diff(least, prepend=-1) != 0]


class Seeds:
    """The minimizers of the texts of a segment: row, place and hash, in order."""

    def __init__(self, row: dict):
        self.row = row
        body = np.frombuffer(unpacked(row["body"]), np.uint8)
        offsets = np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64))))
        hashes, self.bounds = arrays.word_hashes(body, offsets)
        self.codes = (hashes >> np.uint64(32)).astype(np.uint32)
        runs, whole = arrays.windows(hashes, self.bounds, SEED_WORDS)
        at = np.flatnonzero(whole)
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))[at]
        least = least_of(runs[at], WINDOW, rows)
        self.rows, self.seeds = rows[least], arrays.mix(runs[at][least] + np.uint64(1))
        self.places = at[least] - self.bounds[:-1][self.rows]

    def distinct(self, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct seeds, the bucket of each, and the seed of each minimizer."""
        seeds, which = np.unique(self.seeds, return_inverse=True)
        return seeds, ((seeds >> np.uint64(32)) * np.uint64(many)) >> np.uint64(32), which

    def documents(self, which: np.ndarray, many: int) -> np.ndarray:
        """Documents of the segment that hold each distinct seed."""
        pairs = np.sort(which * np.int64(len(self.row["sizes"])) + self.rows)
        pairs = pairs[np.diff(pairs, prepend=-1) != 0]
        return np.bincount(pairs // max(1, len(self.row["sizes"])), minlength=many)

    def holders(self, many: int) -> np.ndarray:
        """Documents that hold the seed of each minimizer, 0 if only one does."""
        seeds, bucket, which = self.distinct(many)
        totals = np.zeros(len(seeds), np.int64)
        for hit in self.row["found"]:
            at = np.searchsorted(bucket, np.uint64(hit["bucket"])) + numbers(hit["hits"], "<u4").astype(np.int64)
            totals[at] = numbers(hit["totals"], "<u4")
        return totals[which]

    def contexts(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Hashes of the words around seeds, MARGIN on both sides or as far as the text goes."""
        scale = np.cumprod(np.full(len(self.codes) + 1, _STEP))
        inverse = np.cumprod(np.full(len(self.codes) + 1, _UNSTEP))
        before = np.append(np.uint64(0), np.cumsum(arrays.mix(self.codes.astype(np.uint64)) * scale[:-1]))
        at = self.bounds[:-1][rows] + places
        low = np.maximum(self.bounds[:-1][rows], at - MARGIN)
        high = np.minimum(self.bounds[1:][rows], at + SEED_WORDS + MARGIN)
        sides = ((at - low) * (2 * MARGIN + SEED_WORDS + 1) + high - at).astype(np.uint64)
        return arrays.mix((before[high] - before[low]) * inverse[low] + arrays.mix(sides))


def key_rows(table: DataFrame, many: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            own = Seeds(row)
            seeds, bucket, which = own.distinct(many)
            counts = own.documents(which, len(seeds))
            starts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
            low = (seeds & np.uint64(0xFFFFFFFF)).astype("<u4")
            counts = counts.astype("<u4")
            pairs = list(zip(starts.tolist(), [*starts.tolist()[1:], len(seeds)]))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[starts].astype(np.int64)), pa.array([row["segment"]] * len(starts), pa.int64()),
                pa.array([low[a:b].tobytes() for a, b in pairs], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary())],
                names=["bucket", "segment", "keys", "counts"])

    return table.mapInArrow(run, KEY_SCHEMA)


def shared_keys(table: pa.Table) -> pa.Table:
    """For each segment of a bucket: its seeds that several documents hold, and how many do."""
    keys = [numbers(x, "<u4") for x in table.column("keys").to_pylist()]
    edges = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
    counts = np.concatenate([numbers(x, "<u4") for x in table.column("counts").to_pylist()]).astype(np.int64)
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, counts)[which]
    out: dict[str, list] = {"segment": [], "bucket": [], "hits": [], "totals": []}
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        hits = np.flatnonzero(total[a:b] > 1)
        if len(hits):
            values = (table.column("segment")[i].as_py(), table.column("bucket")[i].as_py(),
                      hits.astype("<u4").tobytes(), total[a:b][hits].astype("<u4").tobytes())
            for own, value in zip(out.values(), values):
                own.append(value)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def stretches(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of the stretches of seeds that follow one another in a text.

    Neighbouring minimizers are at most WINDOW words apart, so with a wider gap
    a minimizer between is not shared.
    """
    return np.cumsum(np.append(True, (np.diff(places) > WINDOW) | (rows[1:] != rows[:-1])))


def sequences(seeds: np.ndarray, places: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first seed, words, hash) of chosen sequences of ``SEQUENCE`` shared seeds in a row."""
    if len(seeds) < SEQUENCE:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    begin = np.flatnonzero(stretch[SEQUENCE - 1:] == stretch[:len(stretch) - SEQUENCE + 1])
    folded = np.full(len(begin), SEQUENCE, np.uint64)
    for step in range(SEQUENCE):
        folded = arrays.mix(folded * _STEP + seeds[begin + step] + (places[begin + step] - places[begin]).astype(np.uint64))
    chosen = least_of(folded, WINDOW, stretch[begin])
    begin, folded = begin[chosen], folded[chosen]
    return begin, places[begin + SEQUENCE - 1] - places[begin] + SEED_WORDS, folded


def reaches(
    seeds: np.ndarray, places: np.ndarray, stretch: np.ndarray, least_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first seed, words, hash) of all shared seeds within one reach.

    The first minimizer of ``least_words`` words begins in the first WINDOW of
    them; those that follow within the reach lie inside as well. So two equal
    passages of that length have one such hash in common.
    """
    reach = least_words - SEED_WORDS - WINDOW + 1
    wide = int(places.max(initial=0)) + reach + 2
    line = stretch * wide + places
    last = np.searchsorted(line, line + reach, "right") - 1
    # All of the reach is shared: the next seed of the stretch lies beyond it, or just before its end.
    begin = np.flatnonzero((reach - (places[last] - places) < WINDOW) & (last > np.arange(len(places))))
    # Prefix sums of what each seed adds, scaled so that they do not depend on where a text begins.
    scale = np.cumprod(np.full(wide, _STEP)) if len(begin) else np.empty(0, np.uint64)
    inverse = np.cumprod(np.full(wide, _UNSTEP)) if len(begin) else scale
    added = np.cumsum(arrays.mix(seeds) * scale[places]) if len(begin) else scale
    before = np.append(np.uint64(0), added)
    folded = arrays.mix((before[last[begin] + 1] - before[begin]) * inverse[places[begin]])
    return begin, places[last[begin]] - places[begin] + SEED_WORDS, folded


def by_part(part: np.ndarray) -> np.ndarray:
    """The order of rows by part; short numbers are sorted by their digits."""
    return np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")


def packed_rows(kind: int, part: np.ndarray, fields: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    """A row per part, with the fields (a row of numbers each) of all that goes there, in order of ``key``.

    Equal bytes of all numbers of a field lie together, so what is in order takes little room.
    """
    if key is None:
        order = by_part(part)
    else:
        order = np.argsort(key)
        order = order[by_part(part[order])]
    part, fields = part[order], np.take(fields.astype("<i8", copy=False), order, axis=1)
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    bodies = []
    for a, b in zip(starts, [*starts[1:], len(part)]):
        raw = np.ascontiguousarray(fields[:, a:b]).view("u1").reshape(len(fields), b - a, 8)
        planes = np.empty((len(fields), 8, b - a), np.uint8)
        for i in range(8):
            planes[:, i] = raw[:, :, i]
        bodies.append(packed(planes.tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(starts), pa.int32()), pa.array(part[starts], pa.int64()), pa.array(bodies, pa.binary())],
        names=["kind", "part", "body"])


def packed_links(links: np.ndarray, parts: int) -> pa.RecordBatch:
    """``packed_rows`` of links by the stretch of the document, those of a pair of documents together in order of place."""
    _, segment, row, _, source_segment, source_row, x, _, _ = links.astype(np.int64).view(np.uint64)
    key = arrays.mix(segment) >> np.uint64(52) << np.uint64(52) | (row & np.uint64(0xFFF)) << np.uint64(40)
    key |= mixed(source_segment, source_row) >> np.uint64(40) << np.uint64(16) | x & np.uint64((1 << 16) - 1)
    return packed_rows(LINK, dealt(parts, links[1], links[2], links[6] >> STRETCH), links, key)


def unpacked_rows(table: pa.Table, fields: Sequence[str]) -> np.ndarray:
    bodies = [numbers(unpacked(x), "u1").reshape(len(fields), 8, -1) for x in table.column("body").to_pylist()]
    ends = np.cumsum([body.shape[2] for body in bodies]).tolist()
    out = np.empty((len(fields), ends[-1], 8), np.uint8)
    for body, end in zip(bodies, ends):
        for i in range(8):
            out[:, end - body.shape[2]:end, i] = body[:, i]
    return out.view("<i8")[:, :, 0]


def mixed(*keys: np.ndarray) -> np.ndarray:
    """A hash of the keys of each row."""
    out = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        out = arrays.mix(out * _STEP + key.view(np.uint64) + np.uint64(1))
    return out


def dealt(parts: int, *keys: np.ndarray) -> np.ndarray:
    """The part of each row, by a hash of its keys."""
    return (mixed(*keys) % np.uint64(parts)).astype(np.int64)


def seed_rows(asked: DataFrame, many: int, parts: int, least_words: int) -> DataFrame:
    """Shared seeds and longer ones made of them, with the document and place of each, packed by seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for row in rows_of(batches):
            own = Seeds(row)
            holders = own.holders(many)
            mine = np.flatnonzero(holders > 1)
            if not len(mine):
                continue
            rows, places, shared, holders = own.rows[mine], own.places[mine], own.seeds[mine], holders[mine]
            stretch = stretches(rows, places)
            kinds = [(np.arange(len(mine)), np.full(len(mine), SEED_WORDS), shared),
                     sequences(shared, places, stretch), reaches(shared, places, stretch, least_words)]
            first, words, hashes = (np.concatenate(x) for x in zip(*kinds))
            # In order of the text: so they take less room.
            order = np.argsort(first, kind="stable")
            first, words, hashes = first[order], words[order], hashes[order]
            ids, ties = (np.array(row[name], np.int64)[rows[first]] for name in ("ids", "ties"))
            # A longer seed has at most as many holders as its first one.
            turns = -(-holders[first] // HOT)
            salt = (arrays.mix(ids.view(np.uint64)) % turns.astype(np.uint64)).astype(np.int64)
            salt[turns > 1] += 1
            waiting.append(np.stack([
                hashes.astype(np.uint64).view(np.int64), salt, ids, ties, np.full(len(first), row["segment"], np.int64),
                rows[first], places[first], words]).astype(np.int64))
            if sum(x.shape[1] for x in waiting) >= HANDED:
                fields = np.concatenate(waiting, axis=1)
                yield packed_rows(LINK, dealt(parts, fields[0], fields[1]), fields)
                waiting = []
        if waiting:
            fields = np.concatenate(waiting, axis=1)
            yield packed_rows(LINK, dealt(parts, fields[0], fields[1]), fields)

    return asked.mapInArrow(run, PACK_SCHEMA)


def link_part(table: pa.Table, parts: int, by: Sequence[str]) -> pa.Table:
    """Links of each place with two earlier documents that hold its seed, packed by document.

    They are the nearest one and the first one; ``rest_part`` links the others. All places of a document are
    linked, each to the place of the same number in the source, counted again
    from the first one where the source has fewer. The first holders of the parts of a frequent seed come out as leaders.
    """
    fields = dict(zip(SEED_FIELDS, unpacked_rows(table, SEED_FIELDS)))
    order = np.lexsort([fields[name] for name in ("place", "row", "segment", "tie", "id", *by[::-1])])
    fields = {name: values[order] for name, values in fields.items()}

    def starts(names: Sequence[str]) -> np.ndarray:
        new = np.zeros(len(order), bool)
        new[:1] = True
        for name in names:
            new[1:] |= fields[name][1:] != fields[name][:-1]
        return new

    new_seed, new_holder = starts(by), starts((*by, "id", "tie", "segment", "row"))
    holder = np.cumsum(new_holder) - 1
    begin = np.flatnonzero(new_holder)
    size = np.diff(np.append(begin, len(order)))
    alone = new_seed[begin]  # no holder before
    number = np.arange(len(begin))
    nearest, first = np.maximum(number - 1, 0), np.maximum.accumulate(np.where(alone, number, 0))
    out = []
    for source, wanted in ((nearest, ~alone), (first, ~alone & (first != nearest))):
        mine = source[holder]
        place = begin[mine] + (np.arange(len(order)) - begin[holder]) % size[mine]
        linked = np.flatnonzero(wanted[holder] & (fields["id"][place] < fields["id"]))
        there = place[linked]
        links = np.stack([
            *[fields[name][linked] for name in ("id", "segment", "row")],
            *[fields[name][there] for name in ("id", "segment", "row")],
            fields["place"][linked], fields["place"][there], fields["words"][linked]])
        out.append(packed_links(links, parts))
    if "salt" in by:
        leading = np.flatnonzero(alone[holder] & (fields["salt"] > 0))
        leaders = np.stack([fields[name][leading] for name in SEED_FIELDS])
        out.append(packed_rows(LEADER, dealt(parts, leaders[0]), leaders))
    return pa.Table.from_batches(out)


def link_rows(seeds: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Packed links of all shared seeds, within the parts of each seed and among their leaders, and the written table they come from."""

    def near(table: pa.Table) -> pa.Table:
        return link_part(table, parts, ("seed", "salt"))

    def across(table: pa.Table) -> pa.Table:
        return link_part(table, parts, ("seed",))

    found = settle_alone(seeds.groupBy("part").applyInArrow(near, PACK_SCHEMA), "links")
    leaders = found.where(F.col("kind") == LEADER)
    links = found.where(F.col("kind") == LINK).unionByName(leaders.groupBy("part").applyInArrow(across, PACK_SCHEMA))
    return links, found


def open_seeds(rows: np.ndarray, places: np.ndarray, covered: list) -> np.ndarray:
    """Whether each seed lies outside the spans (row, first word, words) that are covered."""
    if not covered:
        return np.ones(len(rows), bool)
    wide = max(int(places.max(initial=0)), max(x["start_word"] + x["n_words"] for x in covered)) + SEED_WORDS + 1
    spans = np.array(sorted((x["row"] * wide + x["start_word"], x["row"] * wide + x["start_word"] + x["n_words"]) for x in covered))
    ends = np.maximum.accumulate(spans[:, 1])
    at = rows * wide + places
    before = np.searchsorted(spans[:, 0], at, "right") - 1
    return (before < 0) | (ends[np.maximum(before, 0)] < at + SEED_WORDS)


def turns_of(seeds: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of each seed, and the period of each run (0: a seed alone).

    A run says a phrase of at most WINDOW words over and over: one seed, again and again at one distance.
    """
    step = np.where((np.diff(seeds.view(np.int64)) == 0) & (np.diff(rows) == 0), np.diff(places), 0)
    step = np.append(0, np.where(step <= WINDOW, step, 0))
    # A seed between two distances belongs to the run before it.
    new = (step == 0) | (step != np.append(0, step[:-1])) & (np.append(0, step[:-1]) != 0)
    number = np.cumsum(new) - 1
    period = np.zeros(int(number[-1]) + 1 if len(number) else 0, np.int64)
    period[number[~new]] = step[~new]
    return number, period


def neighbours(
    seeds: np.ndarray, holders: np.ndarray, rows: np.ndarray, places: np.ndarray, free: np.ndarray, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(seed, code) of the seeds near each one that are no rarer: 30 bits of the hash, the side, and if one of the two is open.

    Pairs of seeds with at most LINKED holders are left out: the first round links all of them.
    So are pairs within one run: ``run_links`` links these.
    """
    rank = holders.astype(np.uint64) << np.uint64(40) | seeds >> np.uint64(24)
    code = (arrays.mix(seeds) >> np.uint64(34)).astype(np.uint32) << np.uint32(2)
    many = holders > LINKED
    wide = int(places.max(initial=0)) + MARGIN + 1
    line = rows * wide + places
    # The seeds after each one that are far enough from it, and near enough.
    begin, end = np.searchsorted(line, line + REST_SPAN - SEED_WORDS), np.searchsorted(line, line + MARGIN, "right")
    at, other = np.arange(len(seeds)), begin
    found = []
    while True:
        near = other < end[at]
        at, other = at[near], other[near]
        if not len(at):
            break
        far = turn[other] != turn[at]
        one, two = at[far].astype(np.int32), other[far].astype(np.int32)
        open_, one_rank, two_rank = (free[one] | free[two]).astype(np.uint32), rank[one], rank[two]
        # The other one is no rarer, and not rare.
        ahead, back = many[two] & (two_rank >= one_rank), many[one] & (one_rank >= two_rank)
        found.append((one[ahead], code[two[ahead]] | np.uint32(2) | open_[ahead]))
        found.append((two[back], code[one[back]] | open_[back]))
        other = other + 1
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.uint32)
    return tuple(np.concatenate(x) for x in zip(*found))


def packed_lists(kind: int, part: np.ndarray, fields: np.ndarray, lists: np.ndarray) -> pa.RecordBatch:
    """``packed_rows`` of fields whose last one says how many numbers of ``lists`` belong to each row."""
    order = by_part(part)
    begin = np.cumsum(fields[-1]) - fields[-1]
    part, fields, begin = part[order], np.take(fields, order, axis=1), begin[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    bodies = []
    for a, b in zip(starts, [*starts[1:], len(part)]):
        many = fields[-1, a:b]
        at = np.repeat(begin[a:b] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        bodies.append(packed(b"".join((
            np.int64(b - a).tobytes(), np.ascontiguousarray(fields[:, a:b]).tobytes(), lists[at].astype("<u4").tobytes()))))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(starts), pa.int32()), pa.array(part[starts], pa.int64()), pa.array(bodies, pa.binary())],
        names=["kind", "part", "body"])


def unpacked_lists(table: pa.Table, fields: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    rows, lists = [], []
    for body in table.column("body").to_pylist():
        body = unpacked(body)
        end = 8 + 8 * len(fields) * int(numbers(body[:8], "<i8")[0])
        rows.append(numbers(body[8:end], "<i8").reshape(len(fields), -1))
        lists.append(numbers(body[end:], "<u4"))
    return np.concatenate(rows, axis=1), np.concatenate(lists)


def run_rows(own: Seeds, seeds: np.ndarray, rows: np.ndarray, places: np.ndarray, free: np.ndarray,
             turn: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Runs of REST_SPAN words or more, with what of them is open."""
    begin = np.flatnonzero(np.diff(turn, prepend=-1))
    last = np.append(begin[1:], len(turn)) - 1
    words = places[last] - places[begin] + SEED_WORDS
    kept = np.flatnonzero((period > 0) & (words >= REST_SPAN))
    far = int(places.max(initial=0)) + SEED_WORDS + 1
    first = np.minimum.reduceat(np.where(free, places, far), begin) - places[begin]
    end = np.maximum.reduceat(np.where(free, places + SEED_WORDS, -1), begin) - places[begin]
    begin, first, end = begin[kept], first[kept], end[kept]
    ids, ties = (np.array(own.row[name], np.int64)[rows[begin]] for name in ("ids", "ties"))
    return np.stack([
        seeds[begin].view(np.int64), ids, ties, np.full(len(begin), own.row["segment"], np.int64), rows[begin], places[begin],
        period[kept], words[kept], np.where(end > 0, first, 0), np.maximum(end, 0)])


def rest_rows(asked: DataFrame, many: int, parts: int) -> DataFrame:
    """Shared seeds with another one near, their surroundings and masks, packed by seed: one a seed and MARGIN words.

    With them go the runs, packed by the same seeds.
    """

    def handed(runs: list[np.ndarray], near: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if runs:
            fields = np.concatenate(runs, axis=1)
            yield packed_rows(RUN, dealt(parts, fields[0]), fields)
        if near:
            fields = np.concatenate([x for x, _ in near], axis=1)
            yield packed_lists(LINK, dealt(parts, fields[0]), fields, np.concatenate([x for _, x in near]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[list, list] = [], []
        for row in rows_of(batches):
            own = Seeds(row)
            holders = own.holders(many)
            mine = np.flatnonzero(holders > 1)
            rows, places, seeds = own.rows[mine], own.places[mine], own.seeds[mine]
            if not len(mine):
                continue
            free = open_seeds(rows, places, row["covered"] or [])
            turn, period = turns_of(seeds, rows, places)
            runs = run_rows(own, seeds, rows, places, free, turn, period)
            if runs.shape[1]:
                waiting[0].append(runs)
            one, code = neighbours(seeds, holders[mine], rows, places, free, turn)
            if not len(one):
                continue
            near, open_ = np.zeros(len(mine), bool), np.zeros(len(mine), bool)
            near[one] = True
            open_[one[code & 1 == 1]] = True
            order = np.lexsort((places, ~open_, places // MARGIN, rows, seeds))
            order = order[near[order]]
            new = np.append(True, np.any([np.diff(x[order]) != 0 for x in (seeds, rows, places // MARGIN)], axis=0))
            first = order[new]
            number = np.zeros(len(mine), np.int64)
            number[order] = np.cumsum(new) - 1
            # Of equal codes of a row the open one stays.
            entries = number[one]
            entries <<= 32
            entries |= code
            del one, code
            entries.sort()
            entries = entries[np.append(entries[1:] >> 1 != entries[:-1] >> 1, True)]
            ids, ties = (np.array(row[name], np.int64)[rows[first]] for name in ("ids", "ties"))
            fields = np.stack([
                seeds[first].view(np.int64), ids, ties, np.full(len(first), row["segment"], np.int64), rows[first], places[first],
                own.contexts(rows[first], places[first]).view(np.int64), np.bincount(entries >> 32, minlength=len(first))])
            waiting[1].append((fields, (entries & 0xFFFFFFFF).astype(np.uint32)))
            if sum(len(x) for _, x in waiting[1]) >= 4 * HANDED:
                yield from handed(*waiting)
                waiting = [], []
        yield from handed(*waiting)

    return asked.mapInArrow(run, PACK_SCHEMA)


def common_bits(seed: np.ndarray, ids: np.ndarray, asked: np.ndarray, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (later, earlier) of rows of one seed, in order of seeds and ids, whose masks have a bit in common."""
    begin = np.flatnonzero(np.append(True, np.diff(seed) != 0))
    size = np.diff(np.append(begin, len(seed)))
    place = np.arange(len(seed)) - np.repeat(begin, size)
    at = np.flatnonzero((np.repeat(size, size) <= SMALL) & (asked != 0))
    for back in range(1, SMALL):
        at = at[place[at] >= back]
        if not len(at):
            break
        hit = at[(asked[at] & held[at - back] != 0) & (ids[at - back] < ids[at])]
        yield hit, hit - back
    for a, b in zip(begin[size > SMALL].tolist(), (begin + size)[size > SMALL].tolist()):
        asking = a + np.flatnonzero(asked[a:b])
        holding = a + np.flatnonzero(held[a:b])
        for i in range(0, len(asking), TILE):
            for j in range(0, len(holding), TILE):
                later, earlier = asking[i:i + TILE, None], holding[None, j:j + TILE]
                x, y = np.nonzero((asked[later] & held[earlier] != 0) & (ids[earlier] < ids[later]))
                yield asking[i:i + TILE][x], holding[j:j + TILE][y]


def common_neighbours(
    seeds: np.ndarray, ids: np.ndarray, holder: np.ndarray, first: np.ndarray, codes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (later, earlier) of rows of one seed that have a code in common, by ``holder`` the row of each code.

    Rows ask for their open codes, the ``first`` one of equal surroundings has the codes of all of them.
    """
    key = arrays.mix(seeds[holder].view(np.uint64) * _STEP + (codes >> 1).astype(np.uint64))
    asked = (codes & 1 == 1) & (ids[holder] == ids[first[holder]])
    order = np.argsort(key)
    begin = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
    size = np.diff(np.append(begin, len(order)))
    kept = order[np.repeat((size > 1) & np.logical_or.reduceat(asked[order], begin), size)]
    mine = kept[asked[kept]]
    key, rows = np.append(key[kept], key[mine]), np.append(first[holder[kept]], holder[mine])
    held = np.repeat(np.array([1, 0], np.uint64), (len(kept), len(mine)))
    order = np.lexsort((held, rows, ids[rows], key))
    key, rows, held = key[order], rows[order], held[order]
    once = np.append(True, (np.diff(key) != 0) | (np.diff(rows) != 0) | (np.diff(held.view(np.int64)) != 0))[:len(rows)]
    key, rows, held = key[once], rows[once], held[once]
    waiting: list[np.ndarray] = []
    for later, earlier in common_bits(key, ids[rows], np.uint64(1) - held, held):
        waiting.append(rows[later] * len(first) + rows[earlier])
        if sum(len(x) for x in waiting) > HANDED:
            waiting = [distinct(np.concatenate(waiting))]
            if len(waiting[0]) > HANDED // 2:
                yield np.divmod(waiting.pop(), len(first))
    if waiting:
        yield np.divmod(distinct(np.concatenate(waiting)), len(first))


def run_links(table: pa.Table, parts: int, least_words: int, least_identity: float) -> list[pa.RecordBatch]:
    """Links of the open runs with the longest run of the same phrase that an earlier document has.

    What two runs have in common is the shorter one, so no other run matches more. An open part that is
    longer is linked in turns, the last one ending with the run. A shorter run than ``least_words`` is
    linked to as many words as it can be like.
    """
    fields = dict(zip(RUN_FIELDS, unpacked_rows(table, RUN_FIELDS)))
    order = np.lexsort([fields[name] for name in ("place", "row", "segment", "tie", "id", "period", "seed")])
    fields = {name: values[order] for name, values in fields.items()}
    number = np.arange(len(order))
    new = np.append(True, (np.diff(fields["seed"]) != 0) | (np.diff(fields["period"]) != 0))
    begin = np.maximum.accumulate(np.where(new, number, 0))
    holder = np.maximum.accumulate(np.where(np.append(True, np.diff(fields["id"]) != 0) | new, number, 0))
    longest = np.cumsum(new) * (int(fields["words"].max()) + 1) + fields["words"]
    rise = np.append(True, longest[1:] > np.maximum.accumulate(longest)[:-1])
    best = np.maximum.accumulate(np.where(rise, number, 0))
    mine = np.flatnonzero((fields["end"] > 0) & (holder > begin))
    there = best[holder[mine] - 1]
    words, common = fields["words"][mine], np.minimum(fields["words"][mine], fields["words"][there])
    period, first, end = (fields[name][mine] for name in ("period", "first", "end"))
    alike = np.where(common < least_words, np.minimum(words, (common / least_identity + 1e-9).astype(np.int64)), common)
    whole = alike // period * period
    # The last turn that lies within the run, in step with the first word of the other one.
    last = (words - alike) // period * period
    low = np.minimum(first // period * period, last)
    turns = np.maximum(1, -(-(end - low - (alike - whole)) // whole))
    turns[alike < least_words] = 1
    which = np.repeat(np.arange(len(mine)), turns)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(turns) - turns, turns)
    at = np.minimum(low[which] + turn * whole[which], last[which])
    mine, there = mine[which], there[which]
    links = np.stack([
        *[fields[name][mine] for name in ("id", "segment", "row")], *[fields[name][there] for name in ("id", "segment", "row")],
        fields["place"][mine] + at, fields["place"][there], alike[which] | common[which] << 32])
    return [packed_links(links, parts)] if len(mine) else []


def rest_part(table: pa.Table, parts: int, least_words: int = LEAST_WORDS, least_identity: float = LEAST_IDENTITY) -> pa.Table:
    """Links of the open seeds with all earlier holders that share a second seed near, packed by document.

    Holders with equal surroundings are one text: its first document asks and is asked, the others are linked to it.
    """
    kind = np.array(table.column("kind"))
    runs, table = table.filter(pa.array(kind == RUN)), table.filter(pa.array(kind == LINK))
    out = run_links(runs, parts, least_words, least_identity) if len(runs) else []
    if not len(table):
        return pa.Table.from_batches(out, empty_links())
    fields, codes = unpacked_lists(table, REST_FIELDS)
    fields = dict(zip(REST_FIELDS, fields))
    holder = np.repeat(np.arange(len(fields["many"])), fields["many"])
    order = np.lexsort([fields[name] for name in ("place", "row", "segment", "tie", "id", "context", "seed")])
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    holder = back[holder]
    fields = {name: values[order] for name, values in fields.items()}
    new = np.append(True, (np.diff(fields["seed"]) != 0) | (np.diff(fields["context"]) != 0))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    asks = np.zeros(len(order), bool)
    asks[holder[codes & 1 == 1]] = True
    copies = np.flatnonzero(asks & (fields["id"] > fields["id"][first]))
    found = [(copies, first[copies])]
    pairs = common_neighbours(fields["seed"], fields["id"], holder, first, codes)
    for later, earlier in (*found, *pairs):
        links = np.stack([
            *[fields[name][later] for name in ("id", "segment", "row")],
            *[fields[name][earlier] for name in ("id", "segment", "row")],
            fields["place"][later], fields["place"][earlier], np.full(len(later), SEED_WORDS)])
        if len(later):
            out.append(packed_links(links, parts))
    return pa.Table.from_batches(out, empty_links())


def empty_links() -> pa.Schema:
    return packed_rows(LINK, np.empty(0, np.int64), np.empty((1, 0), np.int64)).schema


def equal_runs(pair: np.ndarray, x: np.ndarray, y: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and (x, x_end, y, y_end) of the matches, those of a pair that touch on one diagonal joined; in order of pair and x."""
    if not len(pair):
        return pair, np.empty((0, 4), np.int64)
    order = np.lexsort((x, x.astype(np.int64) - y, pair))
    pair, x, y, words = (v[order].astype(np.int64) for v in (pair, x, y, words))
    ends = x + words
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] - y[1:] != x[:-1] - y[:-1]) | (pair[1:] != pair[:-1])
    # Ends seen so far on the same diagonal: diagonals are set apart by more than any place.
    shift = np.cumsum(new) * (int(ends.max()) + 1)
    top = np.maximum.accumulate(ends + shift)
    new[1:] |= x[1:] + shift[1:] > top[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(x)) - 1
    begin, end = x[heads], top[tails] - shift[tails]
    runs = np.stack([begin, end, y[heads], y[heads] + end - begin], 1)
    order = np.lexsort((runs[:, 2], runs[:, 0], pair[heads]))
    return pair[heads][order], runs[order]


def best_before(rows: list[list[int]], gap_cost: float) -> tuple[list[float], list[int]]:
    """Score of the best chain that ends with each run, and the run before it there (-1: none)."""
    heights = sorted({row[3] for row in rows})
    ending = sorted(range(len(rows)), key=lambda i: rows[i][1])
    # A Fenwick tree over the heights: prefix maxima of (value, run).
    size, none = len(heights), (-1.0, -1)
    tree = [none] * (size + 1)
    scores: list[float] = []
    before: list[int] = []
    ended = 0
    for x1, x2, y1, _ in rows:
        # Runs are at least SEED_WORDS > SLACK long, so those that end here began before.
        while rows[ending[ended]][1] <= x1 + SLACK:
            j = ending[ended]
            entry = scores[j] + gap_cost * (rows[j][1] + rows[j][3]), j
            rank = bisect_left(heights, rows[j][3]) + 1
            while rank <= size:
                if tree[rank] < entry:
                    tree[rank] = entry
                rank += rank & -rank
            ended += 1
        best = none
        if ended:
            rank = bisect_right(heights, y1 + SLACK)
            while rank:
                if tree[rank] > best:
                    best = tree[rank]
                rank &= rank - 1
        value, index = best
        gain = value - gap_cost * (x1 + y1) if index >= 0 else 0.0
        scores.append(x2 - x1 + max(0.0, gain))
        before.append(index if gain > 0 else -1)
    return scores, before


def chains(rows: list[list[int]], gap_cost: float = GAP_COST) -> list[list[list[int]]]:
    """Best collinear chains of runs (x, x_end, y, y_end) in order of x, each run in one chain.

    A chain scores the words of its runs, less ``gap_cost`` for each word that it
    skips in either document; runs may overlap by SLACK words. It may bridge
    unrelated text, so it comes as the runs that it is made of.
    """
    if len(rows) == 1:
        parts = [rows]
    else:
        scores, before = best_before(rows, gap_cost)
        used, parts = [False] * len(rows), []
        for last in sorted(range(len(rows)), key=scores.__getitem__, reverse=True):
            links, i = [], last
            while i >= 0 and not used[i]:
                used[i] = True
                links.append(rows[i])
                i = before[i]
            if links:
                parts.append(links[::-1])
    return [part for part in parts
            if part[-1][1] - part[0][0] >= LEAST_SPAN and linked_words(part) - len(part) * (SEED_WORDS - 1) >= LEAST_SEEDS]


def linked_words(part: list[list[int]]) -> int:
    return sum([row[1] - row[0] for row in part])


def settle_alone(df: DataFrame, name: str) -> DataFrame:
    """``settle``, and what the query has shuffled is deleted when it is written."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return settle(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def merged(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Spans of chains and the words that the best one links; those of one pair that lie near each other become one."""
    if len(found) < 2:
        return found
    out: list[list[int]] = []
    for x, x_end, y, y_end, words in sorted(found):
        for span in out:
            if x <= span[1] + MARGIN and abs((y - x) - (span[3] - span[1])) <= MARGIN and y >= span[2] - MARGIN:
                span[1:] = max(span[1], x_end), min(span[2], y), max(span[3], y_end), max(span[4], words)
                break
        else:
            out.append([x, x_end, y, y_end, words])
    return [tuple(span) for span in out]


def strongest(spans: list[tuple]) -> list[tuple]:
    """The spans of a document, and whether they lie within another one with as many linked words."""
    spans = sorted(spans, key=lambda s: (-s[-1], -s[3], s))
    begin, end = np.array([s[6] for s in spans]), np.array([s[7] for s in spans])
    kept: list[int] = []
    spare = []
    for i in range(len(spans)):
        spare.append(bool(((begin[kept] <= begin[i]) & (end[kept] >= end[i])).any()))
        if not spare[-1]:
            kept.append(i)
    return [(*span[:-1], left) for span, left in zip(spans, spare)]


def chain_part(table: pa.Table, rest: bool = False) -> pa.Table:
    """Spans of the chains of the linked seeds of each pair of documents; all but the strongest of each are spare.

    Links of the second round (``rest``) need no chain: each stands for two seeds.
    """
    fields = dict(zip(LINK_FIELDS, unpacked_rows(table, LINK_FIELDS)))
    pair = ("segment", "row", "source_segment", "source_row")
    key = mixed(*[fields[name] for name in pair])
    order = np.argsort(key)
    ends = _sorted_runs([fields[name][order] for name in pair])
    if len(ends) > len(_sorted_runs([key[order]])):
        # Two pairs have one hash.
        order = np.lexsort([fields[name] for name in pair])
        ends = _sorted_runs([fields[name][order] for name in pair])
    del key
    # A single seed is worth a chain only if it is a long one.
    worth = (np.diff(ends) >= LEAST_SEEDS) | (fields["words"][order[ends[:-1]]] >= LEAST_SPAN) | rest
    by_document: dict[tuple[int, int], list[tuple]] = {}
    cuts = np.flatnonzero(np.diff(ends[:-1] // CHAINED, prepend=-1)).tolist()
    for begin, end in zip(cuts, [*cuts[1:], len(worth)]):
        at = order[ends[begin]:ends[end]]
        number = np.repeat(np.arange(begin, end), np.diff(ends[begin:end + 1]))
        x, y, words = (fields[name][at] for name in ("x", "y", "words"))
        near = worth[number] & (words == SEED_WORDS if rest else True)
        which, runs = equal_runs(number[near], x[near], y[near], words[near])
        heads = np.searchsorted(which, np.arange(begin, end + 1)).tolist()
        owners = np.stack([fields[name][order[ends[begin:end]]] for name in LINK_FIELDS[:6]], 1)
        for i in np.flatnonzero(worth[begin:end]).tolist():
            own, rows = owners[i].tolist(), runs[heads[i]:heads[i + 1]].tolist()
            if rest:
                spans = merged([(*row, row[1] - row[0]) for row in rows])
                mine = slice(ends[begin + i] - ends[begin], ends[begin + i + 1] - ends[begin])
                # Turns of a run stay apart.
                spans += [(i, i + (n & 0xFFFFFFFF), j, j + (n >> 32), n >> 32)
                          for i, j, n in zip(x[mine].tolist(), y[mine].tolist(), words[mine].tolist()) if n > SEED_WORDS]
            else:
                spans = merged([(part[0][0], part[-1][1], part[0][2], part[-1][3], linked_words(part)) for part in chains(rows, WIDE_COST)])
            by_document.setdefault((own[1], own[2]), []).extend([(*own, *span) for span in spans])
    out = [span for spans in by_document.values() for span in ([(*s[:-1], False) for s in spans] if rest else strongest(spans))]
    kinds = [pa.int64(), pa.int64(), pa.int32()] * 2 + [pa.int32()] * 4 + [pa.bool_()]
    columns = zip(*out) if out else [()] * len(kinds)
    return pa.table({name: pa.array(c, k) for name, c, k in zip((*CHAIN_COLUMNS, "spare"), columns, kinds)})


def word_codes(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """(chain, side, begin, codes): 32-bit word hashes of the spans in ``wanted``, with margins.

    ``wanted`` has (segment, row, chain, side, a, b). A seed leads to the holder
    before it only, so a segment is asked for spans in proportion to its text.
    """
    spans = wanted.groupBy("segment").agg(F.collect_list(F.struct("row", "chain", "side", "a", "b")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            body = unpacked(row["body"])
            ends = np.cumsum(np.array(row["sizes"], np.int64))
            # Only the texts with spans.
            rows = sorted({span["row"] for span in row["spans"]})
            number = {own: i for i, own in enumerate(rows)}
            begin = (ends[rows] - np.array(row["sizes"], np.int64)[rows]).tolist()
            texts = [body[a:b] for a, b in zip(begin, ends[rows].tolist())]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
            hashes, bounds = arrays.word_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets)
            codes = (hashes >> np.uint64(32)).astype(np.uint32)
            out: list[tuple] = []
            for span in row["spans"]:
                low, high = bounds[number[span["row"]]:number[span["row"]] + 2]
                begin = max(0, span["a"] - MARGIN)
                own = codes[low + begin:min(high, low + span["b"] + MARGIN)]
                out.append((span["chain"], span["side"], begin, own.tobytes()))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["chain", "side", "begin", "codes"])

    return table.join(spans.hint("shuffle_hash"), "segment").mapInArrow(run, "chain long, side int, begin long, codes binary")


class Pairs:
    """Pairs of spans: their words, and which of them the other span has as well.

    Words are numbered so that two have one number if they are equal and of one pair.
    """

    def __init__(self, mine: Sequence[bytes], theirs: Sequence[bytes]):
        both = [body for pair in zip(mine, theirs) for body in pair]
        self.codes = np.frombuffer(b"".join(both), np.uint32)
        self.sizes = np.array([len(body) for body in both], np.int64) // 4
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        self.span = np.repeat(np.arange(len(both)), self.sizes)
        _, self.kinds = np.unique(self.span.astype(np.uint64) >> np.uint64(1) << np.uint64(32) | self.codes, return_inverse=True)
        side = self.span & 1
        held = np.zeros((2, int(self.kinds.max(initial=-1)) + 1), bool)
        held[side, self.kinds] = True
        self.shared = held[1 - side, self.kinds]
        self.before = np.append(0, np.cumsum(self.shared))

    def can_match(self, least_words: int, least_identity: float) -> np.ndarray:
        """Whether enough words of some stretch of the first span are in the other one and the other way round; no passage is without."""
        many = len(self.sizes)
        number = np.repeat(np.arange(many), self.sizes + 1)
        step = np.zeros(len(number))
        step[np.arange(len(self.span)) + self.span + 1] = self.shared - least_identity
        rise = np.cumsum(step)
        begin = self.bounds[:-1] + np.arange(many)
        # Spans are set apart by more than they can rise or fall, so each has minima of its own.
        rise -= np.repeat(rise[begin], self.sizes + 1) + number * (2.0 * self.sizes.max(initial=0) + 2)
        low = np.minimum.accumulate(rise)
        # Some stretch of that size or longer has the share: the sums at its ends rise by it.
        size = np.where(number & 1, math.ceil(least_words * least_identity), least_words)
        at = np.flatnonzero(np.arange(len(number)) - begin[number] >= size)
        at = at[rise[at] >= low[at - size[at]] - 1e-6]
        good = np.zeros(many, bool)
        good[number[at]] = True
        return good[::2] & good[1::2]

    def matches(self, asked: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, x, y) of all runs of SEED_WORDS words that both spans of an ``asked`` pair have.

        Of several places of a run in the second span the nearest one on each side of the line
        between ``ends``, the difference of places at both ends of the first one, counts.
        """
        runs, whole = arrays.windows(arrays.mix(self.kinds.astype(np.uint64) + np.uint64(1)), self.bounds, SEED_WORDS)
        at = np.flatnonzero(whole & asked[self.span >> 1])
        at = at[self.before[at + SEED_WORDS] - self.before[at] == SEED_WORDS]
        _, kind = np.unique(runs[at], return_inverse=True)
        place, span = at - self.bounds[self.span[at]], self.span[at]
        wide = 4 * int(self.sizes.max(initial=0)) * 2 + 4
        mine = span & 1 == 0
        held = np.sort(kind[~mine] * wide + place[~mine])
        x, pair, kind = place[mine], span[mine] >> 1, kind[mine]
        both = self.sizes[::2] + self.sizes[1::2]
        line = x + ends[pair, 0] + (ends[pair, 1] - ends[pair, 0]) * x / np.maximum(1, self.sizes[::2])[pair]
        after = np.searchsorted(held, kind * wide + np.clip(np.rint(line), 0, 2 * both[pair] + 2).astype(np.int64))
        found = []
        for at in (after - 1, after):
            known = (at >= 0) & (at < len(held))
            known[known] &= held[at[known]] // wide == kind[known]
            found.append((pair[known], x[known], held[at[known]] % wide))
        return tuple(np.concatenate(v) for v in zip(*found))

    def pair(self, i: int) -> Pair:
        return Pair(*[(self.codes[a:b], self.before[a:b + 1]) for a, b in zip(self.bounds[2 * i:2 * i + 2], self.bounds[2 * i + 1:2 * i + 3])])


class Pair:
    """The words of two spans, as arrays and as lists, and how many of the first words of each the other one has."""

    def __init__(self, mine: tuple[np.ndarray, np.ndarray], theirs: tuple[np.ndarray, np.ndarray]):
        (self.a, self.a_shared), (self.b, self.b_shared) = mine, theirs
        self.mine, self.theirs = self.a.tolist(), self.b.tolist()

    def most_common(self, x: tuple[int, int], y: tuple[int, int]) -> int:
        """A bound on ``common_length`` of a part of each."""
        return int(min(self.a_shared[x[1]] - self.a_shared[x[0]], self.b_shared[y[1]] - self.b_shared[y[0]]))


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit for each word of ``a``."""
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - short:][::-1] != b[len(b) - short:][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, int] = {}
    for i, code in enumerate(a.tolist()):
        places[code] = places.get(code, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for code in b.tolist():
        if code in places:
            hit = row & places[code]
            row = (row + hit | row - hit) & full
    return head + tail + len(a) - row.bit_count()


def extension(a: list[int], b: list[int], i: int, j: int, step: int, cost: int = 2) -> tuple[int, int]:
    """(words, equal words) of the best run from ``i`` and ``j`` on: 1 for an equal word, less ``cost`` for another."""
    score = same = words = best = 0
    top = -cost
    for k in range(1, (min(len(a) - i, len(b) - j) if step > 0 else min(i, j) + 1) + 1):
        if a[i] == b[j]:
            score += 1
            same += 1
            if score >= top:
                top, words, best = score, k, same
        else:
            score -= cost
            if top - score > DROP:
                break
        i += step
        j += step
    return (words, best) if top >= 0 else (0, 0)


def gapped_extension(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """(words of a, words of b, equal words): 2 for an equal word, less 1 for a missing one on either side."""
    places: dict[int, int] = {}
    for j, code in enumerate(b):
        places[code] = places.get(code, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for code in a:
        if code in places:
            hit = row & places[code]
            row = (row + hit | row - hit) & full
        rows.append(row)
    if row == full:
        return 0, 0, 0
    # Bits that are gone from a row count the words that the first of ``a`` have in common with those of ``b``.
    bits = np.unpackbits(np.array(rows, "<u8").view(np.uint8).reshape(-1, 8), axis=1, count=len(b), bitorder="little")
    common = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    np.cumsum(1 - bits, axis=1, out=common[:, 1:])
    score = 4 * common - np.arange(len(a) + 1)[:, None] - np.arange(len(b) + 1)
    i, j = np.unravel_index(score.argmax(), score.shape)
    return int(i), int(j), int(common[i, j])


def extended(pair: Pair, x: tuple[int, int], y: tuple[int, int], loose: bool = False) -> tuple[int, int, int, int, int]:
    """Extended spans of a chain and the equal words of the extensions: (x, x_end, y, y_end, same).

    ``loose`` goes on while half of the words are equal, and over missing words.
    """
    a, b = pair.mine, pair.theirs
    sides = []
    for i, j, step in ((x[0] - 1, y[0] - 1, -1), (x[1], y[1], 1)):
        words, same = extension(a, b, i, j, step, 1 if loose else 2)
        side = words, words, same
        if loose:
            ends = (a[i:i + MARGIN], b[j:j + MARGIN]) if step > 0 else (a[max(0, i + 1 - MARGIN):i + 1][::-1], b[max(0, j + 1 - MARGIN):j + 1][::-1])
            side = max(side, gapped_extension(*ends), key=lambda s: 4 * s[2] - s[0] - s[1])
        sides.append(side)
    (left, left_y, left_same), (right, right_y, right_same) = sides
    return x[0] - left, x[1] + right, y[0] - left_y, y[1] + right_y, left_same + right_same


def most_matched(pair: Pair, x: tuple[int, int], y: tuple[int, int]) -> int:
    """A bound on the words that a chain can match, its margins included."""
    total = x[1] - x[0]
    for one, other in ((slice(max(0, x[0] - MARGIN), x[0]), slice(max(0, y[0] - MARGIN), y[0])),
                       (slice(x[1], x[1] + MARGIN), slice(y[1], y[1] + MARGIN))):
        held = set(pair.theirs[other])
        total += sum([code in held for code in pair.mine[one]])
    return total


def similar_parts(
    pair: Pair, runs: list[list[int]], least_words: int, least_identity: float
) -> Iterator[tuple[int, int, int, int, int]]:
    """Aligned parts of a chain that are long and similar enough: (x, x_end, y, y_end, matched).

    A chain that is not is parted at its widest gap, and its parts are aligned
    again, so passages with unrelated text between them come out one by one.
    """
    gaps = [max(two[0] - one[1], two[2] - one[3]) for one, two in zip(runs, runs[1:])]
    todo = [(0, len(runs) - 1)]
    while todo:
        first, last = todo.pop()
        spans = (runs[first][0], runs[last][1]), (runs[first][2], runs[last][3])
        x, x_end, y, y_end, same = extended(pair, *spans)
        if x_end - x < least_words:
            # Edits near the ends must not cut a passage short of the least length.
            if most_matched(pair, *spans) < least_identity * least_words:
                continue
            x, x_end, y, y_end, same = extended(pair, *spans, loose=True)
        words = x_end - x
        if words < least_words:
            continue
        size = max(words, y_end - y)
        if (same + pair.most_common(*spans)) / size >= least_identity:
            matched = same + common_length(pair.a[slice(*spans[0])], pair.b[slice(*spans[1])])
            if matched / size >= least_identity:
                yield x, x_end, y, y_end, matched
                continue
        if last > first:
            wide = gaps[first:last]
            cut = first + wide.index(max(wide))
            todo += [(cut + 1, last), (first, cut)]


def outermost(spans: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """The spans that do not lie within another one's words of the first document; longer ones first."""
    kept: list[tuple[int, int, int, int, int]] = []
    for span in sorted(spans, key=lambda s: (s[0] - s[1], s)):
        if not any(x <= span[0] and span[1] <= x_end for x, x_end, *_ in kept):
            kept.append(span)
    return kept


def within(found: list[tuple[int, int]], begin: int, end: int) -> bool:
    """Whether the spans found cover all of [begin, end) together."""
    for a, b in sorted(found):
        if a <= begin < b:
            begin = b
    return begin >= end


def blocks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Pairs (the words of both spans come last) of about ALIGNED words together."""
    block, size = [], 0
    for row in rows:
        block.append(row)
        size += len(row[-2]) + len(row[-1])
        if size >= 4 * ALIGNED:
            yield block
            block, size = [], 0
    if block:
        yield block


def aligned(
    batches: Iterator[pa.RecordBatch], least_words: int, least_identity: float, once: bool
) -> Iterator[pa.RecordBatch]:
    """Passages of pairs of spans. Their words are compared for a block of pairs at once, their chains aligned one by one."""
    document, covered = None, []
    names = [part.split()[0] for part in PASSAGE_SCHEMA.split(", ")]
    kinds = {"row": pa.int32(), "identity": pa.float64()}
    for batch in batches:
        out: list[tuple] = []
        for block in blocks(zip(*(c.to_pylist() for c in batch.columns))):
            if once:
                # What is covered before the block is done; the rest is looked at again below.
                block = [row for row in block if row[:2] != document or not within(covered, row[4], row[5])]
            if not block:
                continue
            pairs = Pairs(*([row[k] for row in block] for k in (-2, -1)))
            asked = pairs.can_match(least_words, least_identity)
            # The difference of places where the chain begins and ends, held level beyond.
            ends = np.array([((y1 - y0) - (x1 - x0), (y2 - y0) - (x2 - x0)) for *_, x1, x2, y1, y2, x0, y0, _, _ in block], np.int64)
            which, runs = equal_runs(*(found := pairs.matches(asked, ends.reshape(-1, 2))), np.full(len(found[0]), SEED_WORDS))
            heads = np.searchsorted(which, np.arange(len(block) + 1)).tolist()
            for i in np.flatnonzero(np.diff(heads)).tolist():
                segment, number, doc, source, x1, x2, _, _, x0, y0, _, _ = block[i]
                if document != (segment, number):
                    document, covered = (segment, number), []
                if once and within(covered, x1, x2):
                    continue
                pair = pairs.pair(i)
                spans = [span for part in chains(runs[heads[i]:heads[i + 1]].tolist())
                         for span in similar_parts(pair, part, least_words, least_identity)]
                for x, x_end, y, y_end, matched in outermost(spans):
                    words, theirs = x_end - x, y_end - y
                    covered.append((x + x0, x_end + x0))
                    out.append((segment, number, doc, x + x0, words, source, y + y0, theirs, matched, matched / max(words, theirs)))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(name, pa.int64())) for c, name in zip(zip(*out), names)],
                names=names)


def passages(
    table: DataFrame, spans: DataFrame, least_words: int, least_identity: float, once: bool = False
) -> DataFrame:
    """Passages that are long and similar enough in the spans of chains and around them.

    With ``once`` the spans of a document are taken one after the other, longer
    ones first, and those that the passages found so far cover are done.
    """
    sides = [("segment", "row", "x", "x_end"), ("source_segment", "source_row", "y", "y_end")]
    wanted = [spans.select(*[F.col(c).alias(to) for c, to in zip(side, ("segment", "row", "a", "b"))],
                           "chain", F.lit(k).alias("side")) for k, side in enumerate(sides)]
    codes = word_codes(table, wanted[0].unionByName(wanted[1]))
    both = codes.groupBy("chain").agg(*[
        F.max(F.when(F.col("side") == k, F.struct("begin", "codes"))).alias(name) for k, name in enumerate(("mine", "theirs"))])
    pairs = spans.join(both, "chain").select(
        "segment", "row", "id", "source", "x", "x_end", "y", "y_end", F.col("mine.begin").alias("x0"), F.col("theirs.begin").alias("y0"),
        F.col("mine.codes").alias("a"), F.col("theirs.codes").alias("b"))

    if once:
        words = (F.col("x_end") - F.col("x")).desc()
        pairs = pairs.repartition("segment", "row").sortWithinPartitions("segment", "row", words, "x", "source", "y", "y_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return aligned(batches, least_words, least_identity, once)

    return pairs.mapInArrow(run, PASSAGE_SCHEMA)


def rest_spans(
    table: DataFrame, asked: DataFrame, spans: DataFrame, done: DataFrame, many: int, parts: int,
    least_words: int, least_identity: float
) -> DataFrame:
    """Spans of the second round: of open seeds and all their earlier holders, and spare chains that have open words."""
    covered = done.groupBy("segment").agg(F.collect_list(F.struct("row", "start_word", "n_words")).alias("covered"))
    # Lists of neighbours are longer than rows of links, so there are more parts of them.
    seeds = rest_rows(asked.join(covered.hint("shuffle_hash"), "segment", "left"), many, 2 * parts)
    links = seeds.groupBy("part").applyInArrow(lambda part: rest_part(part, parts, least_words, least_identity), PACK_SCHEMA)
    found = links.groupBy("part").applyInArrow(lambda part: chain_part(part, True), CHAIN_SCHEMA + ", spare boolean")
    spare = spans.where("spare").join(
        done.select(F.col("segment").alias("s"), F.col("row").alias("r"), "start_word", "n_words"),
        F.expr("segment = s and row = r and start_word <= x and start_word + n_words >= x_end"), "left_anti")
    return found.withColumn("chain", F.xxhash64(*CHAIN_COLUMNS)).unionByName(spare).dropDuplicates(["chain"])


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
    least_identity: float = LEAST_IDENTITY,
) -> DataFrame:
    """One row per passage of a document that an earlier one (by id) holds as well.

    ``start_word`` and ``n_words`` say where it is, ``source_doc_id``,
    ``source_start`` and ``source_words`` where the source has it; ``identity``
    is the share of words that align.
    """
    table = segments(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, one: total + one)
    # A seed for every two or three words, about six bytes each.
    many = max(1, -(-(table.agg(F.sum(size)).first()[0] or 0) // (15 * BUCKET)))
    hits = settle_alone(key_rows(table, many).groupBy("bucket").applyInArrow(shared_keys, HIT_SCHEMA), "shared_keys")
    found = hits.groupBy("segment").agg(F.collect_list(F.struct("bucket", "hits", "totals")).alias("found"))
    shared = hits.agg(F.sum(F.octet_length("hits"))).first()[0] or 0
    parts = max(1, -(-shared // (4 * PART_SEEDS)) * 2)
    asked = table.join(found.hint("shuffle_hash"), "segment")
    links, written = link_rows(seed_rows(asked, many, parts, least_words), parts)
    # The links of a stretch of a document: a few for each of its words at most.
    chained = links.groupBy("part").applyInArrow(lambda part: chain_part(part), CHAIN_SCHEMA + ", spare boolean")
    spans = settle_alone(chained.withColumn("chain", F.xxhash64(*CHAIN_COLUMNS)), "chains")
    # Links are the largest table beside the texts, and the chains are written.
    discard(written)
    done = settle_alone(passages(table, spans.where("not spare"), least_words, least_identity), "passages")
    rest = settle_alone(rest_spans(table, asked, spans, done, many, parts, least_words, least_identity), "rest")
    discard(hits)
    more = passages(table, rest, least_words, least_identity, once=True)
    # Chains that lie apart may reach one passage.
    return done.unionByName(more).drop("segment", "row").distinct().withColumnRenamed("doc_id", id_col)

"""Bytes of repeated strings go: every string of 100 bytes stays where it starts first.

The suffixes of all texts, cut at ``length`` bytes (windows), are sorted bucket
by bucket, and of equal ones all but the first lose their bytes.

* Documents are packed into segments of some megabytes, written once.
* Of each window the least hash of its 32-byte strings names its bucket, so
  equal windows get one bucket at one distance from that string (the seed).
  Neighbouring windows share a seed and travel as one context string.
* A segment first sends only the seeds' hashes, four bytes each and each once.
  Seeds that occur once in all segments end there.
* The contexts of the other seeds, each once a segment, are dealt to parts by
  seed. A part sorts one bucket of suffixes at a time by their first and last
  bytes. Ties are resolved by ranks of a difference cover sample: positions
  whose remainder modulo 13 is 0, 1, 3 or 9, ranked once per part by doubling.
  Any two suffixes have a shift below 13 at which both are in the sample, so
  equal heads, equal ranks at that shift and equal tails make equal windows.
  Memory is bounded by a part's contexts and one block of its suffixes.
* Seeds with more than ``HOT`` occurrences deal each window by itself, by the
  hash of the whole window: a frequent seed is spread over as many parts as it
  has surroundings, and a frequent window costs at most one row a segment.

All comparisons that remove bytes are on the bytes themselves.

Defined cases: a null text is empty; a null id comes before all others; rows
with one id and one text are one document, each of them treated like it; rows
with one id and different texts are ordered by a hash of the text; other
columns are not read; an empty table gives no rows. A document longer than a
segment is a segment of its own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from georisk.llm.arrays import mix
from georisk.workspace import new_path

NO_ID = -(1 << 63)
# Bytes of a segment and of a part's contexts, bytes of contexts that a task deals at once, seed
# hashes of a bucket, occurrences of a seed beyond which its windows are dealt one by one,
# suffixes sorted at once, windows hashed at once.
SEGMENT, PART, DEALT, BUCKET, HOT, BLOCK, CHUNK = 1 << 21, 1 << 22, 1 << 24, 1 << 19, 4096, 1 << 19, 1 << 15
SEED = 32
PERIOD, COVER = 13, (0, 1, 3, 9)
HEAD, REACH = 16, 81  # bytes compared at the start, and bytes that a sample rank stands for
_PLACE = np.uint64((1 << 20) - 1)
_STEP = 0x9E3779B97F4A7C15 | 1

SEGMENT_SCHEMA = (
    "segment long, ids array<long>, ties array<long>, copies array<long>, sizes array<long>, body binary")
SEED_SCHEMA = "bucket long, segment long, keys binary, counts binary"
HIT_SCHEMA = "segment long, bucket long, hits binary, hot binary, n long"
CONTEXT_SCHEMA = "part long, facts binary, texts binary"
# What travels with a context: its seed, its document (id and tie), the seed's place there, the
# segment, the first window's place there, the windows, the seed's distance, and the length.
FACTS = ("seed", "id", "tie", "pos", "segment", "at", "own", "lead", "size")
MARK_SCHEMA = "segment long, starts binary, sizes binary"


_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(1))


def numbers(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind)


def packed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor().compress(raw)


def unpacked(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


# --- segments ------------------------------------------------------------------

def segments(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents packed into rows of about ``SEGMENT`` bytes, in order within each."""

    def pack(number: int, rows: list[tuple]) -> pa.RecordBatch:
        alike = Counter(rows)
        ids, ties, texts = zip(*sorted(alike, key=lambda row: (NO_ID if row[0] is None else row[0], row[1], row[2])))
        copies = [alike[row] for row in zip(ids, ties, texts)]
        kinds = (pa.int64(), *[pa.list_(pa.int64())] * 4, pa.binary())
        values = (number, list(ids), list(ties), copies, [len(x) for x in texts], packed(b"".join(texts)))
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(values, kinds)],
            names=["segment", "ids", "ties", "copies", "sizes", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for key, tie, text in zip(*(batch.column(c) for c in range(3))):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                if rows and size + len(body) > SEGMENT:
                    yield pack(number, rows)
                    number, rows, size = number + 1, [], 0
                rows.append((key.as_py(), tie.as_py(), body))
                size += len(body)
        if rows:
            yield pack(number, rows)

    text = F.coalesce(F.col(text_col), F.lit(""))
    path = new_path(docs.sparkSession, "segments")
    table = docs.select(F.col(id_col).cast("long"), F.xxhash64(text), text.cast("binary")).mapInArrow(
        run, SEGMENT_SCHEMA)
    table.write.parquet(path)
    return docs.sparkSession.read.schema(table.schema).parquet(path)


class Segment:
    """One row of the segment table, its seeds and the windows each of them owns."""

    def __init__(self, row: dict, length: int):
        self.row, self.length = row, length
        self.text = unpacked(row["body"])
        self.body = np.frombuffer(self.text, np.uint8)
        self.bounds = np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64))))
        found = [self._seeds(low, min(low + CHUNK, len(self.body))) for low in range(0, len(self.body), CHUNK)]
        first, own, lead, seed = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4
        self.first, self.own, self.lead, self.seed = first, own, lead, seed.astype(np.uint64)

    def _whole(self, low: int, high: int) -> np.ndarray:
        """Places in [low, high), counted from low, whose window ends in the same document."""
        ends = self.bounds[np.searchsorted(self.bounds, low, "right"):]
        ends = ends[:np.searchsorted(ends, high + self.length)] - low
        broken = np.zeros(high - low + 1, np.int64)
        np.add.at(broken, np.clip(ends - self.length + 1, 0, high - low), 1)
        np.add.at(broken, np.clip(ends, 0, high - low), -1)
        return np.flatnonzero(np.cumsum(broken[:-1]) == 0)

    def _seeds(self, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Windows that start in [low, high), as runs of windows with one seed."""
        buf = self.body[low:high + self.length - 1]
        whole = self._whole(low, min(high, low + len(buf) - self.length + 1)) if len(buf) >= self.length else buf[:0]
        if not len(whole):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        # Hash of the SEED bytes from each place on, by doubling.
        run, size = _BYTES[buf], 1
        while size < SEED:
            run = run[:-size] * np.uint64(pow(_STEP, size, 1 << 64)) + run[size:]
            size *= 2
        run = mix(run)
        # The least hash of each window, the first one on ties: the place rides in the low bits.
        least = (run & ~_PLACE) | np.arange(len(run), dtype=np.uint64)
        reach, span = 1, self.length - SEED + 1
        while reach < span:
            step = min(reach, span - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        place = (least[whole] & _PLACE).astype(np.int64)
        new = np.ones(len(whole), bool)
        new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)
        at = np.flatnonzero(new)
        own = np.diff(np.append(at, len(whole)))
        # Least hashes are all small: mixed anew, they spread over the buckets.
        return whole[at] + low, own, place[at] - whole[at], mix(run[place[at]] + np.uint64(1))

    def buckets(self, many: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct seeds in order, the bucket of each, their counts, and the seed of each run."""
        seeds, which, counts = np.unique(self.seed, return_inverse=True, return_counts=True)
        return seeds, ((seeds >> np.uint64(32)) * np.uint64(many)) >> np.uint64(32), counts, which


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


# --- seeds that occur more than once -------------------------------------------

def seed_rows(table: DataFrame, many: int, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            seeds, bucket, counts, _ = Segment(row, length).buckets(many)
            marks = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
            low = (seeds & np.uint64(0xFFFFFFFF)).astype("<u4")
            counts = np.minimum(counts, 0xFFFF).astype("<u2")
            edges = [*marks.tolist(), len(seeds)]
            pairs = list(zip(edges, edges[1:]))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[marks].astype(np.int64)), pa.array([row["segment"]] * len(marks), pa.int64()),
                pa.array([low[a:b].tobytes() for a, b in pairs], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary())],
                names=["bucket", "segment", "keys", "counts"])

    return table.mapInArrow(run, SEED_SCHEMA)


def repeated_seeds(table: pa.Table) -> pa.Table:
    """For each segment of a bucket: which of its seeds occur again, and which are hot."""
    keys = [numbers(x, "<u4") for x in table.column("keys").to_pylist()]
    edges = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
    counts = np.concatenate([numbers(x, "<u2") for x in table.column("counts").to_pylist()]).astype(np.int64)
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, counts)[which]
    out: dict[str, list] = {"segment": [], "bucket": [], "hits": [], "hot": [], "n": []}
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        hits = np.flatnonzero(total[a:b] > 1)
        if len(hits):
            out["segment"].append(table.column("segment")[i].as_py())
            out["bucket"].append(table.column("bucket")[i].as_py())
            out["hits"].append(hits.astype("<u4").tobytes())
            out["hot"].append((total[a:b][hits] > HOT).tobytes())
            out["n"].append(int(counts[a:b][hits].sum()))
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


# --- contexts --------------------------------------------------------------------

class Dealer:
    """Contexts of a task, handed on as one packed row per part."""

    def __init__(self, parts: int):
        self.parts, self.facts, self.keys, self.texts, self.size = parts, [], [], [], 0

    def add(self, segment: Segment, at: list, own: list, lead: list, seed: list, key: list, texts: list) -> None:
        start, lead = np.array(at, np.int64), np.array(lead, np.int64)
        doc = np.searchsorted(segment.bounds, start, "right") - 1
        ids = np.array([NO_ID if x is None else x for x in segment.row["ids"]], np.int64)[doc]
        ties = np.array(segment.row["ties"], np.int64)[doc]
        self.facts.append(np.stack([
            np.array(seed, np.uint64).view(np.int64), ids, ties, start + lead - segment.bounds[doc],
            np.full(len(at), segment.row["segment"], np.int64), start, np.array(own, np.int64), lead,
            np.fromiter(map(len, texts), np.int64)]))
        self.keys.append(mix(np.array(key, np.uint64)) % np.uint64(self.parts))
        self.texts += texts
        self.size += int(self.facts[-1][-1].sum())

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.texts:
            return
        facts, part = np.concatenate(self.facts, axis=1), np.concatenate(self.keys).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, facts, texts = part[order], facts[:, order], [self.texts[i] for i in order.tolist()]
        starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        pairs = list(zip(starts, [*starts[1:], len(part)]))
        yield pa.RecordBatch.from_arrays([
            pa.array(part[starts]), pa.array([packed(facts[:, a:b].tobytes()) for a, b in pairs], pa.binary()),
            pa.array([packed(b"".join(texts[a:b])) for a, b in pairs], pa.binary())], names=["part", "facts", "texts"])
        self.__init__(self.parts)


def context_rows(asked: DataFrame, many: int, parts: int, length: int) -> DataFrame:
    """The contexts of repeated seeds, each once a segment; later equal ones as spans without text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(parts)
        for row in rows_of(batches):
            segment = Segment(row, length)
            seeds, bucket, _, which = segment.buckets(many)
            repeated, hot = np.zeros(len(seeds), bool), np.zeros(len(seeds), bool)
            for hit in row["found"]:
                places = np.searchsorted(bucket, np.uint64(hit["bucket"])) + numbers(hit["hits"], "<u4").astype(np.int64)
                repeated[places] = True
                hot[places] = numbers(hit["hot"], bool)
            body, seen = segment.text, set()
            out: tuple[list, ...] = ([], [], [], [], [], [])
            again: list[tuple[int, int]] = []
            chosen = np.flatnonzero(repeated[which])
            runs = (x[chosen].tolist() for x in (segment.first, segment.own, segment.lead, segment.seed, hot[which]))
            for first, own, lead, seed, each in zip(*runs):
                # A hot seed sends its windows one by one, dealt by the whole window.
                size = 1 if each else own
                for at in range(first, first + own, size):
                    text = body[at:at + size + length - 1]
                    if text not in seen:
                        seen.add(text)
                        dealt = zlib.crc32(text) if each else seed
                        for values, value in zip(out, (at, size, lead - (at - first), seed, dealt, text)):
                            values.append(value)
                    elif again and again[-1][0] + again[-1][1] == at:
                        again[-1] = (again[-1][0], again[-1][1] + size)
                    else:
                        again.append((at, size))
            for at, size in again:
                for values, value in zip(out, (at, size, 0, 0, at, b"")):
                    values.append(value)
            if out[0]:
                dealer.add(segment, *out)
            if dealer.size > DEALT:
                yield from dealer.rows()
        yield from dealer.rows()

    return asked.mapInArrow(run, CONTEXT_SCHEMA)


# --- blocks of suffixes ------------------------------------------------------------

def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks of rows of keys, the first key counting most; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), bool)
    for key in keys:
        values = key[order]
        new[1:] |= values[1:] != values[:-1]
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new, dtype=np.uint64)
    return out


class CoverRanks:
    """Ranks of the ``REACH`` bytes at every sample place of a text."""

    def __init__(self, text: np.ndarray):
        self.slots = np.full(PERIOD, -1, np.int64)
        self.slots[list(COVER)] = np.arange(len(COVER))
        rounds = -(-len(text) // PERIOD) + 1
        places = (np.arange(rounds)[:, None] * PERIOD + np.array(COVER)).ravel()
        wide = np.concatenate((text, np.zeros(2 * PERIOD + HEAD + 8, np.uint8)))
        self.words = np.ndarray((len(wide) - 7,), ">u8", wide, strides=(1,))
        ranks = dense(*(self.words[np.minimum(places + k, len(wide) - 8)] for k in (0, 8)))
        # 16 bytes, then 16 + 13, 29 + 26 and 55 + 26.
        for turns in (1, 2, 2):
            ranks = self._joined(ranks, turns * len(COVER))
        self.ranks = ranks

    @staticmethod
    def _joined(ranks: np.ndarray, shift: int) -> np.ndarray:
        later = np.zeros(len(ranks), np.uint64)
        later[:-shift] = ranks[shift:] + np.uint64(1)
        return dense((ranks << np.uint64(32)) | later)

    def sampled(self, at: np.ndarray) -> np.ndarray:
        return self.slots[at % PERIOD] >= 0

    def of(self, at: np.ndarray) -> np.ndarray:
        return self.ranks[at // PERIOD * len(COVER) + self.slots[at % PERIOD]]


def classes(*keys: np.ndarray) -> np.ndarray:
    """Numbers of rows of keys, equal for equal rows; grouped by a hash and compared in full."""
    spread = keys[0].astype(np.uint64)
    for key in keys[1:]:
        spread = mix(spread) + key.astype(np.uint64)
    order = np.argsort(spread, kind="stable")
    differs = np.zeros(len(order), bool)
    for key in keys:
        values = key[order]
        differs[1:] |= values[1:] != values[:-1]
    by_hash = spread[order]
    if (differs[1:] & (by_hash[1:] == by_hash[:-1])).any():
        return dense(*keys)
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(differs, dtype=np.uint64)
    return out


def later_ones(cover: CoverRanks, at: np.ndarray, bucket: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes of some buckets equal one with a lower ``order``."""
    ends = [cover.words[at + k] for k in (*range(0, HEAD, 8), *range(REACH - 5, length - 7, 8))]
    if (length - REACH + 5) % 8:
        ends.append(cover.words[at + length - 8])
    tie = classes(bucket, *ends)
    left = np.flatnonzero(np.bincount(tie.astype(np.int64))[tie.astype(np.int64)] > 1)
    out = np.zeros(len(at), bool)
    for shift in range(PERIOD):
        mine = left[cover.sampled(at[left] + shift)]
        if not len(mine):
            continue
        key = (tie[mine] << np.uint64(32)) | cover.of(at[mine] + shift)
        by_key = np.argsort(key)
        values, ranks = key[by_key], order[mine][by_key]
        new = np.ones(len(by_key), bool)
        new[1:] = values[1:] != values[:-1]
        least = np.minimum.reduceat(ranks, np.flatnonzero(new))[np.cumsum(new) - 1]
        out[mine[by_key[ranks > least]]] = True
    return out


def first_contexts(texts: list[bytes], lead: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which contexts have no equal one of a lower rank; of equal ranks all stay or all go."""
    seen: dict[tuple[int, bytes], int] = {}
    out, leads, ranks = np.zeros(len(texts), bool), lead.tolist(), rank.tolist()
    for i in np.argsort(rank, kind="stable").tolist():
        out[i] = seen.setdefault((leads[i], texts[i]), ranks[i]) == ranks[i]
    return out


def sort_part(table: pa.Table, length: int) -> pa.Table:
    """Windows of a part that occur earlier, as spans of window starts for each segment."""
    facts = [numbers(unpacked(x), "<i8").reshape(len(FACTS), -1) for x in table.column("facts").to_pylist()]
    seed, key, tie, pos, from_segment, first, own, lead, size = np.concatenate(facts, axis=1)
    body = b"".join(unpacked(x) for x in table.column("texts").to_pylist())
    edges = np.concatenate(([0], np.cumsum(size)))
    texts = [body[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]
    rank = dense(key, tie, pos)
    some = np.flatnonzero(size > 0)
    stays = np.zeros(len(size), bool)
    stays[some] = first_contexts([texts[i] for i in some.tolist()], lead[some], rank[some])
    # A context that is whole in an earlier place is marked whole, like those without text.
    hit_segment, hit_at, hit_size = [from_segment[~stays]], [first[~stays]], [own[~stays]]
    some = np.flatnonzero(stays)
    if len(some):
        text = np.frombuffer(b"".join(texts[i] for i in some.tolist()), np.uint8)
        del texts, body
        begin = np.cumsum(size[some]) - size[some]
        context = np.repeat(np.arange(len(some)), own[some])
        shift = np.arange(len(context)) - np.repeat(np.cumsum(own[some]) - own[some], own[some])
        # Equal windows lie at one distance from one seed.
        distance = (lead[some][context] - shift + (1 << 20)).astype(np.uint64)
        bucket = mix(seed[some].view(np.uint64)[context] + mix(distance))
        at = begin[context] + shift
        by_bucket = np.argsort(bucket)
        in_order = bucket[by_bucket]
        new = np.ones(len(bucket), bool)
        new[1:] = in_order[1:] != in_order[:-1]
        alone = new & np.append(new[1:], True)
        by_bucket, in_order = by_bucket[~alone], in_order[~alone]
        cover = CoverRanks(text) if len(by_bucket) else None
        low = 0
        while low < len(by_bucket):
            # Whole buckets, one block of them at a time.
            edge = min(low + BLOCK, len(by_bucket)) - 1
            high = int(np.searchsorted(in_order, in_order[edge], "right"))
            mine = by_bucket[low:high]
            late = mine[later_ones(cover, at[mine], in_order[low:high], rank[some][context[mine]], length)]
            hit_segment.append(from_segment[some][context[late]])
            hit_at.append(first[some][context[late]] + shift[late])
            hit_size.append(np.ones(len(late), np.int64))
            low = high
    segment, at, size = (np.concatenate(x) for x in (hit_segment, hit_at, hit_size))
    order = np.lexsort((at, segment))
    segment, at, size = segment[order], at[order], size[order]
    new = np.ones(len(at), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + size[:-1])
    heads = np.flatnonzero(new)
    sizes = np.add.reduceat(size, heads) if len(heads) else size
    segment, at = segment[heads], at[heads]
    marks = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.empty(0, np.int64)
    pairs = list(zip(marks.tolist(), [*marks.tolist()[1:], len(segment)]))
    return pa.table({
        "segment": pa.array(segment[marks], pa.int64()),
        "starts": pa.array([at[a:b].astype("<i8").tobytes() for a, b in pairs], pa.binary()),
        "sizes": pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in pairs], pa.binary())})


# --- results -----------------------------------------------------------------------

def removed_spans(segment: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of removed bytes of a segment (start, end), and where each document's runs begin."""
    bounds = np.concatenate(([0], np.cumsum(np.array(segment["sizes"], np.int64))))
    marks = segment["marks"] or []
    starts = np.concatenate([np.empty(0, np.int64), *[numbers(x["starts"], "<i8") for x in marks]])
    sizes = np.concatenate([np.empty(0, np.int64), *[numbers(x["sizes"], "<i8") for x in marks]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], starts[order] + sizes[order] + length - 1
    doc = np.searchsorted(bounds, starts, "right")
    reach = np.maximum.accumulate(ends) if len(ends) else ends
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    ends = np.maximum.reduceat(ends, first) if len(first) else ends
    return starts[first], ends, np.searchsorted(starts[first], bounds)


def result_rows(asked: DataFrame, id_col: str, length: int) -> DataFrame:
    names = [id_col, "n_bytes", "n_removed", "n_spans", "removed", "kept"]
    span = pa.struct([("start", pa.int64()), ("size", pa.int64())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            starts, ends, edges = removed_spans(row, length)
            out: tuple[list, ...] = ([], [], [], [], [], [])
            low, body = 0, unpacked(row["body"])
            for i, (key, size, copies) in enumerate(zip(row["ids"], row["sizes"], row["copies"])):
                own = list(zip(starts[edges[i]:edges[i + 1]].tolist(), ends[edges[i]:edges[i + 1]].tolist()))
                cuts = [low, *[x for pair in own for x in pair], low + size]
                kept = b"".join(body[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                spans = [{"start": a - low, "size": b - a} for a, b in own]
                for values, value in zip(out, (key, size, size - len(kept), len(own), spans, kept)):
                    values.extend([value] * copies)
                low += size
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds)], names=names)

    fields = "n_bytes long, n_removed long, n_spans long, removed array<struct<start: long, size: long>>, kept binary"
    return asked.mapInArrow(run, f"`{id_col}` long, {fields}")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``removed`` spans, ``kept`` bytes.

    Removed is each byte of a text that a ``length``-byte string covers which
    also starts earlier: in a document with a smaller id, or in the same one.
    """
    if not PERIOD - 1 + REACH <= length <= CHUNK // 2:
        raise ValueError(f"length must be {PERIOD - 1 + REACH} to {CHUNK // 2}")
    table = segments(docs, id_col, text_col)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, one: total + one)
    total = table.agg(F.sum(size)).first()[0] or 0
    many = max(1, -(-total // ((length - SEED + 2) // 2 * BUCKET)))
    seeds = seed_rows(table, many, length)
    hits = seeds.groupBy("bucket").applyInArrow(repeated_seeds, HIT_SCHEMA)
    path = new_path(docs.sparkSession, "hits")
    hits.write.parquet(path)
    hits = docs.sparkSession.read.schema(hits.schema).parquet(path)
    contexts = hits.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-contexts * (length + (length - SEED) // 2) // PART))
    found = hits.groupBy("segment").agg(F.collect_list(F.struct("bucket", "hits", "hot")).alias("found"))
    asked = table.join(found.hint("shuffle_hash"), "segment")
    rows = context_rows(asked, many, parts, length)

    def sort(part: pa.Table) -> pa.Table:
        return sort_part(part, length)

    marks = rows.groupBy("part").applyInArrow(sort, MARK_SCHEMA)
    marks = marks.groupBy("segment").agg(F.collect_list(F.struct("starts", "sizes")).alias("marks"))
    return result_rows(table.join(marks.hint("shuffle_hash"), "segment", "left"), id_col, length)

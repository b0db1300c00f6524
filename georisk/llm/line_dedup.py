"""Lines that many documents share are dropped, found by probing minimal perfect hashes.

The distinct line keys are split into shards by hash. Each shard holds a
minimal perfect hash and, at the place it gives a key, the key's fingerprint,
the number of documents with it and the largest of their ids. Documents send
the 12-byte hashes of their lines to the shards and probe these arrays; line
texts are never shuffled or joined.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` is one
document below all others; rows with one ``doc_id`` are one document, and each
of them keeps its own lines; extra columns pass through, except that those
named like a result column are replaced by it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from georisk.llm.arrays import mix
from georisk.workspace import settle

BLANKS = b" \t\n\x0b\x0c\r"
DIGEST = np.dtype([("h", "<i8"), ("fp", "<u4")])
NO_ID = -(1 << 63)
# Lines per shard, lines of a key beyond which it is resolved by itself, and
# the share of all lines beyond which it is: at most 65,536 keys in any table.
SHARD_LINES, HEAVY_LINES, HEAVY_SHARE = 8192, 1000, 65536
LEVELS, ROOM = 48, 1.6

KEY_SCHEMA = "h long, fp long, id long"
INDEX_SCHEMA = (
    "shard long, sizes array<long>, bits array<binary>, rest binary, fps binary, "
    "counts binary, keepers binary")


def line_digest(line: bytes, least: int) -> bytes | None:
    """Hash of the key of a line; None if the key is too short to be looked up."""
    key = line.strip(BLANKS).lower()
    if len(key) < least or (not key.isascii() and len(key.decode()) < least):
        return None
    return blake2b(key, digest_size=12).digest()


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """The distinct line keys of each row that are long enough, as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for text, key in zip(_texts(batch.column(1)), batch.column(0).to_pylist()):
                own = {line_digest(line, least) for line in text.split(b"\n")}
                own.discard(None)
                found.extend(own)
                ids.extend([key] * len(own))
            digests = np.frombuffer(b"".join(found), DIGEST)
            yield pa.RecordBatch.from_arrays([
                pa.array(digests["h"].astype(np.int64)), pa.array(digests["fp"].astype(np.int64)),
                pa.array(ids, pa.int64())], names=["h", "fp", "id"])

    narrow = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, KEY_SCHEMA)


class PerfectHash:
    """Levels of bit sets: a key rests at the first level where it is alone."""

    def __init__(self, sizes: list[int], bits: list[bytes], rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.ranks, base = [], 0
        for size, raw in zip(sizes, bits):
            flags = np.unpackbits(np.frombuffer(raw, np.uint8), count=size)
            self.ranks.append((flags.astype(bool), base + np.cumsum(flags, dtype=np.int64) - 1))
            base += int(flags.sum())
        self.base = base

    @staticmethod
    def joined(h: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return mix(h.astype(np.uint64) + mix(fp.astype(np.uint64)))

    @staticmethod
    def slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(len(left) * ROOM))
            at = cls.slot(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
        return cls(sizes, bits, np.sort(left))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key of the build; -1 or any place for another key."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, (flags, rank)) in enumerate(zip(self.sizes, self.ranks)):
            at = self.slot(keys[left], level, size)
            hit = flags[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            hit = self.rest[at] == keys[left]
            out[left[hit]] = self.base + at[hit]
        return out


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def build_shard(table: pa.Table) -> pa.Table:
    h, fp = _column(table, "h"), _column(table, "fp")
    keys = PerfectHash.joined(h, fp)
    hashes = PerfectHash.build(keys)
    at = hashes.places(keys)
    n = len(keys)
    fps, counts, keepers = np.zeros(n, np.uint32), np.zeros(n, np.uint32), np.zeros(n, np.int64)
    fps[at], keepers[at] = fp, _column(table, "keeper")
    counts[at] = np.minimum(_column(table, "n_docs"), 0xFFFFFFFF)
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
        "sizes": pa.array([hashes.sizes], pa.list_(pa.int64())),
        "bits": pa.array([hashes.bits], pa.list_(pa.binary())),
        "rest": pa.array([hashes.rest.tobytes()], pa.binary()),
        "fps": pa.array([fps.tobytes()], pa.binary()),
        "counts": pa.array([counts.tobytes()], pa.binary()),
        "keepers": pa.array([keepers.tobytes()], pa.binary()),
    })


def probe_shard(probes: pa.Table, index: pa.Table, min_docs: int) -> pa.Table:
    """The probes whose line goes: frequent enough and not in the keeping document."""
    h, fp, ids = (_column(probes, x) for x in ("h", "fp", "id"))
    drop = np.zeros(len(h), bool)
    if index.num_rows and len(h):
        row = {name: index.column(name)[0].as_py() for name in index.column_names}
        hashes = PerfectHash(row["sizes"], row["bits"], np.frombuffer(row["rest"], np.uint64))
        at = hashes.places(PerfectHash.joined(h, fp))
        known = at >= 0
        at = np.maximum(at, 0)
        known &= np.frombuffer(row["fps"], np.uint32)[at] == fp
        frequent = np.frombuffer(row["counts"], np.uint32)[at] >= min_docs
        drop = known & frequent & (np.frombuffer(row["keepers"], np.int64)[at] != ids)
    return pa.table({"h": pa.array(h[drop]), "fp": pa.array(fp[drop]), "id": pa.array(ids[drop])})


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, min_docs: int = 3
) -> DataFrame:
    """The documents without shared lines, with ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without outer ASCII white space, A-Z lower-cased.
    Keys of at least ``least`` code points in at least ``min_docs`` documents
    lose all their lines except in the largest ``id_col`` holding them.
    """
    spark = docs.sparkSession
    seen = settle(line_hashes(docs, id_col, text_col, least).distinct(), "line_hashes")
    keys = settle(
        seen.groupBy("h", "fp").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper")), "line_keys")
    total = keys.agg(F.sum("n_docs")).first()[0] or 0
    shards = max(1, -(-total // SHARD_LINES))
    limit = max(HEAVY_LINES, total // HEAVY_SHARE)
    # At most HEAVY_SHARE rows, as each stands for more than that share of all lines.
    heavy = {(row["h"], row["fp"]): row["keeper"]
             for row in keys.where((F.col("n_docs") > limit) & (F.col("n_docs") >= min_docs)).collect()}
    shard = F.pmod(F.xxhash64("h", "fp"), F.lit(shards)).alias("shard")
    index = keys.where(F.col("n_docs") <= limit).select("*", shard).groupBy("shard").applyInArrow(
        build_shard, INDEX_SCHEMA)

    common = spark.sparkContext.broadcast(heavy)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield batch.filter(pa.array([pair not in known for pair in pairs], pa.bool_()))

    def probe(probes: pa.Table, table: pa.Table) -> pa.Table:
        return probe_shard(probes, table, min_docs)

    asked = (seen.mapInArrow(light, KEY_SCHEMA) if heavy else seen).select("*", shard)
    gone = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, KEY_SCHEMA)
    # One row per document with lost lines; the list is bounded by its lines.
    lost = gone.groupBy(F.col("id").alias("__id")).agg(
        F.collect_list(F.struct("h", "fp")).alias("__lost"))

    added = ("n_lines", "n_dropped")
    base = docs.select(*[c for c in docs.columns if c not in added])
    joined = base.withColumn("__id", F.coalesce(F.col(id_col), F.lit(NO_ID))).join(
        lost.hint("shuffle_hash"), "__id", "left")
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType, True) for f in base.schema.fields],
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = base.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            texts, lines, dropped = _texts(batch.column(text_col)), [], []
            ids, lost_by = batch.column("__id").to_pylist(), batch.column("__lost").to_pylist()
            for i, (text, key, own) in enumerate(zip(texts, ids, lost_by)):
                lines.append(text.count(b"\n") + 1)
                before = len(dropped)
                if own or known:
                    out = {(x["h"], x["fp"]) for x in own or ()}
                    kept = []
                    for line in text.split(b"\n"):
                        digest = line_digest(line, least)
                        if digest is not None:
                            pair = (int.from_bytes(digest[:8], "little", signed=True),
                                    int.from_bytes(digest[8:], "little"))
                            if pair in out or known.get(pair, key) != key:
                                continue
                        kept.append(line)
                    dropped.append(lines[-1] - len(kept))
                    if dropped[-1]:
                        texts[i] = b"\n".join(kept)
                if len(dropped) == before:
                    dropped.append(0)
            columns = {name: batch.column(name) for name in names}
            columns[text_col] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*names, *added])

    return joined.mapInArrow(cut, schema)

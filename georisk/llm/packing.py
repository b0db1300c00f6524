"""Documents as token pieces, packed best-fit into sequences with certified bin counts.

Texts become token ids in Arrow batches; documents longer than a sequence are
cut. The lengths alone are then packed: each group of items is packed best-fit
decreasing, and lower bounds from dual feasible functions certify its number
of bins. Groups with a gap to their bound give up their emptiest bins (a
quarter), others their emptiest one; what is given up is exchanged between
groups by a new hash and packed again, until one group is left.

Defined cases: a null text is empty and holds only the end token; ``doc_id``
may be null or repeat (its rows are packed one by one); an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from georisk.workspace import settle

CAPACITY, END = 1024, 2
GROUP_ITEMS = 8192
BATCH_ROWS = 1000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_encoding(path: str):
    """The byte-level BPE of a tokenizers file as a faster encoder of the same ids.

    Such a file numbers its tokens in the order of its merges, so token ids are
    merge ranks. Special tokens in a text get their own ids, as in the file's
    own library.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # Bytes that print stand for themselves; the others follow from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i
             for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    capacity: int = CAPACITY, end: int = END, with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids; only longer documents are cut, the first piece being the short one."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path)
        special = encoding.special_tokens_set
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoding.encode_to_numpy(text or "", allowed_special=special, disallowed_special=())
                    own = np.append(ids, end).astype("<u4")
                    stop = len(own) % capacity or min(len(own), capacity)
                    begin, piece = 0, 0
                    while begin < len(own):
                        raw = own[begin:stop].tobytes()
                        fields = (key, piece, begin, stop - begin, zlib.crc32(raw), raw if with_ids else None)
                        for column, value in zip(out, fields):
                            column.append(value)
                        begin, stop, piece = stop, stop + capacity, piece + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                labels = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                columns = [pa.array(values, kind) for values, kind in zip(out, kinds)]
                wide = len(columns) if with_ids else len(columns) - 1
                yield pa.RecordBatch.from_arrays(columns[:wide], names=labels[:wide])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound that two families of dual feasible functions give."""
    if not len(lengths):
        return 0
    many = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    number, volume = np.cumsum(many), np.cumsum(many * np.arange(capacity + 1))
    best = int(-(-volume[-1] // capacity))
    # Items above capacity - a alone, those up to half in the room the larger ones leave.
    a = np.arange(0, capacity // 2 + 1)
    half = capacity // 2
    alone = number[capacity] - number[capacity - a]
    large = number[capacity - a] - number[half]
    room = large * capacity - (volume[capacity - a] - volume[half])
    small = volume[half] - np.where(a > 0, volume[np.maximum(a - 1, 0)], 0)
    best = max(best, int((alone + large + np.maximum(0, -(-(small - room) // capacity))).max()))
    # u(x) = x if x (k + 1) / c is whole, else floor(x (k + 1) / c) / k.
    x = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 32):
        whole = x * (k + 1) % capacity == 0
        scaled = np.where(whole, x * k, x * (k + 1) // capacity * capacity)
        best = max(best, int(-(-(many * scaled).sum() // (capacity * k))))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin of each item, and the fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    place = np.empty(len(lengths), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for item in order:
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(fills)
            fills.append(0)
        fills[chosen] += size
        place[item] = chosen
        left = room - size
        if left:
            open_bins[left].append(chosen)
            rooms |= 1 << left
    return place, np.array(fills, np.int64)


def pack_group(table: pa.Table, capacity: int, final: bool) -> pa.Table:
    """Bins of one group of items; those given up for the next round have no bin."""
    lengths = table.column("length").combine_chunks().to_numpy()
    place, fills = best_fit(lengths, capacity)
    gap = len(fills) - lower_bound(lengths, capacity)
    released = np.zeros(len(fills), bool)
    if not final:
        given = np.argsort(fills, kind="stable")[:max(4 * gap, len(fills) // 4) if gap else 1]
        released[given[fills[given] < capacity]] = True
    order = np.lexsort((np.arange(len(place)), place))
    before = np.cumsum(lengths[order]) - lengths[order]
    new = np.ones(len(order), bool)
    new[1:] = place[order][1:] != place[order][:-1]
    base = np.repeat(before[new], np.diff(np.append(np.flatnonzero(new), len(order)))) if len(order) else before
    offset = np.empty(len(place), np.int64)
    offset[order] = before - base
    out = released[place]
    table = table.set_column(table.schema.get_field_index("bin"), "bin", pa.array(place, mask=out))
    table = table.set_column(table.schema.get_field_index("offset"), "offset", pa.array(offset, mask=out))
    return table.set_column(
        table.schema.get_field_index("gap"), "gap", pa.array(np.full(len(place), gap, np.int64)))


def packer(capacity: int, final: bool) -> Callable[[pa.Table], pa.Table]:
    order = [("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]

    def run(table: pa.Table) -> pa.Table:
        return pack_group(table.sort_by(order), capacity, final)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id``, ``offset`` and the group's certified ``gap``."""
    base = [c for c in pieces.columns if c not in ("grp", "bin", "offset", "gap", "sequence_id")]
    items = pieces.select(*base)
    done: list[DataFrame] = []
    step = 0
    left = items.count()
    while left:
        groups = max(1, -(-left // group_items))
        final = groups == 1
        key = F.pmod(F.xxhash64(F.lit(step), F.col("doc_id"), F.col("piece")), F.lit(groups)).alias("grp")
        none = F.lit(None).cast("long")
        ready = items.select(*base, key, none.alias("bin"), none.alias("offset"), none.alias("gap"))

        packed = settle(ready.groupBy("grp").applyInArrow(packer(capacity, final), ready.schema), "packed")
        number = F.lit(step << 56) + F.col("grp") * F.lit(1 << 24) + F.col("bin")
        done.append(packed.where("bin is not null").select(
            *base, number.alias("sequence_id"), "offset", "gap"))
        items = packed.where("bin is null").select(*base)
        left = 0 if final else items.count()
        step += 1
    if not done:
        return items.select("*", *[F.lit(None).cast("long").alias(c) for c in ("sequence_id", "offset", "gap")])
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every document of ``docs`` as pieces placed in sequences."""
    return pack(settle(token_pieces(docs, id_col, text_col, **options), "pieces"), options.get("capacity", CAPACITY))

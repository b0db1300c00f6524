"""Fill-in-the-middle order of texts, cut at lines found by an indexable skip list.

The units of a text are its lines, each with its newline. The ground lane of a
skip list holds them; every lane above holds about half of the nodes of the one
below, each with the units and the code points it spans. Descending by
accumulated units reaches a cut of any rank in a logarithmic number of steps
and gives its place in code points, however long the text is.

Defined cases: a null text is empty; an empty text, a text that holds one of
the three marks, and a text that the rate leaves out stay plain; a null id
draws as the empty id; rows with one id draw the same numbers; extra columns
pass through, those named like a result column are replaced by it; an empty
table gives no rows. Each row is worked on alone, so a hot id is no burden.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from georisk.llm.arrays import mix

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")
TOP = 4  # nodes of the highest lane at which no further lane is built


def line_lengths(text: str) -> np.ndarray:
    """Code points of each line of a text, newlines included."""
    lengths = np.fromiter(map(len, text.split("\n")), np.int64) + 1
    lengths[-1] -= 1
    return lengths if lengths[-1] else lengths[:-1]


class LaneList:
    """An indexable skip list: lanes of nodes with their widths in units and code points."""

    def __init__(self, lengths: np.ndarray):
        units, points = np.ones(len(lengths), np.int64), lengths
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        below = np.arange(len(lengths))
        while True:
            self.lanes.append((units, points, below))
            if len(units) <= TOP:
                return
            # A coin per node, seeded by lane and place, says which nodes rise; the first one always does.
            coins = mix(np.arange(len(units), dtype=np.uint64) + np.uint64(len(self.lanes) << 40))
            rises = (coins & np.uint64(1)).astype(bool)
            rises[0] = True
            if rises.all():
                rises[1::2] = False
            below = np.flatnonzero(rises)
            units, points = np.add.reduceat(units, below), np.add.reduceat(points, below)

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank; the whole length for a rank past the end."""
        node, units, points = 0, 0, 0
        for level in range(len(self.lanes) - 1, -1, -1):
            wide, long, below = self.lanes[level]
            while node < len(wide) and units + wide[node] <= rank:
                units, points, node = units + wide[node], points + long[node], node + 1
            if node == len(wide):
                return int(points)
            node = below[node]
        return int(points)


def draws(seed: int, key: object) -> list[int]:
    digest = sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def rearrange(text: str, key: object, seed: int, rate: int, spm_rate: int) -> tuple:
    """Units, form, code points of prefix and middle (None if plain), and the new text."""
    lengths = line_lengths(text)
    n = len(lengths)
    h1, h2, h3, h4 = draws(seed, key)
    if n == 0 or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None, text
    lanes = LaneList(lengths)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = lanes.place(first), lanes.place(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return n, SPM, a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, PSM, a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    seed: int = 7, rate: int = 100, spm_rate: int = 50,
) -> DataFrame:
    """Documents with ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` of 100 texts are rearranged, ``spm_rate`` of 100 of these with the suffix first.
    """
    base = docs.select(*[c for c in docs.columns if c not in ADDED])
    names = base.columns
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType, True) for f in base.schema.fields],
        *[T.StructField(name, kind) for name, kind in zip(ADDED, kinds)]])
    arrow = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column(text_col).to_pylist(), batch.column(id_col).to_pylist()
            rows = [rearrange(x or "", key, seed, rate, spm_rate) for x, key in zip(texts, keys)]
            found = zip(*rows) if rows else ((),) * len(ADDED)
            columns = [pa.array(values, kind) for values, kind in zip(found, arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, *ADDED])

    return base.mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The first text, from the rearranged one and its form.

    No part holds a mark, and no mark can arise where a part meets one, so the
    first finding of each mark is the one that was put there.
    """
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def cut(text: Column, mark: str) -> tuple[Column, Column]:
        halves = F.split(text, mark, 2)
        return halves[0], halves[1]

    head, rest = cut(body, SUFFIX)
    tail, middle = cut(rest, MIDDLE)
    psm = F.concat(head, middle, tail)
    tail, rest = cut(body, PREFIX)
    head, middle = cut(rest, MIDDLE)
    spm = F.concat(head, middle, tail)
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output))

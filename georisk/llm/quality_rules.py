"""Quality rules as a short-circuit cascade, cheapest rejection first.

Every rule has a cost and rejects some share of documents. Both are measured on
a bounded sample (``SAMPLE_ROWS`` documents, the first by a hash of their ids);
the rules then run in the order of rejections per second, each only on the
documents that all earlier rules kept. The order changes the time and never the
verdict, as a document is kept when no rule rejects it.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a null or empty text has no
words and fails; documents are judged row by row, so null and repeated ids are
allowed; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from georisk.llm import arrays
from georisk.llm.line_crf import _byte_class, _repeated, line_spans

SAMPLE_ROWS = 500
SYMBOLS = _byte_class("#*$%&|<>")
UPPER = _byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _byte_class("abcdefghijklmnopqrstuvwxyz")
VISIBLE = LETTER | (np.arange(256) >= 128)


class Texts:
    """A slice of texts; what rules need of it is computed once, when asked for."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets, self.rows = buf, offsets, len(offsets) - 1
        self.known: dict[str, object] = {}

    def _once(self, name: str, make: Callable):
        if name not in self.known:
            self.known[name] = make()
        return self.known[name]

    def take(self, rows: np.ndarray) -> Texts:
        """Only these rows, their bytes copied together."""
        if len(rows) == self.rows:
            return self
        sizes = np.diff(self.offsets)[rows]
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        picks = np.repeat(self.offsets[:-1][rows] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return Texts(self.buf[picks], offsets)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Bytes of each row with the flag."""
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[self.offsets])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self._once("words", lambda: arrays.words(self.buf, self.offsets))

    def n_words(self) -> np.ndarray:
        return np.diff(self.words()[2])

    def row_of_word(self) -> np.ndarray:
        return self._once("row", lambda: np.repeat(np.arange(self.rows), self.n_words()))

    def hashes(self) -> np.ndarray:
        return self._once("hashes", lambda: arrays.span_hashes(self.buf, *self.words()[:2]))

    def words_per_row(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.row_of_word()[flags], minlength=self.rows)

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the lines that have a word, and whether an earlier line of the row is equal."""
        return self._once("lines", self._lines)

    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, bounds = line_spans(self.buf, self.offsets)
        rows = np.repeat(np.arange(self.rows), np.diff(bounds))
        solid = np.concatenate(([0], np.cumsum(~arrays.SPACE[self.buf], dtype=np.int64)))
        full = solid[ends] > solid[starts]
        starts, ends, rows = starts[full], ends[full], rows[full]
        hashes = arrays.span_hashes(self.buf, starts, ends)
        order = np.lexsort((np.arange(len(rows)), hashes, rows))
        again = np.zeros(len(rows), bool)
        same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        again[order[1:]] = same
        return rows, again


def word_chars(texts: Texts) -> np.ndarray:
    return texts.per_row(~arrays.SPACE[texts.buf] & ((texts.buf & 0xC0) != 0x80))


def symbols(texts: Texts) -> np.ndarray:
    return texts.per_row(SYMBOLS[texts.buf])


def dup_lines(texts: Texts) -> np.ndarray:
    rows, again = texts.lines()
    return np.bincount(rows[again], minlength=texts.rows)


def repeat_words(texts: Texts) -> np.ndarray:
    """Words in three-word windows that the text has twice or more."""
    grams, whole = arrays.windows(texts.hashes(), texts.words()[2], 3)
    covered = np.zeros(len(grams) + 2, bool)
    at = np.flatnonzero(whole)
    at = at[_repeated(grams[at], texts.row_of_word()[at])]
    for j in range(3):
        covered[at + j] = True
    return texts.words_per_row(covered[:len(grams)])


def many_symbols(texts: Texts) -> np.ndarray:
    """More than one symbol in ten words."""
    return 10 * symbols(texts) > texts.n_words()


def many_dup_lines(texts: Texts) -> np.ndarray:
    """More than half of the lines repeat an earlier one."""
    lines = np.bincount(texts.lines()[0], minlength=texts.rows)
    return 2 * dup_lines(texts) > lines


def shouting(texts: Texts) -> np.ndarray:
    """More than half of the letters A to Z are capitals."""
    return 2 * texts.per_row(UPPER[texts.buf]) > texts.per_row(LETTER[texts.buf])


def exclaiming(texts: Texts) -> np.ndarray:
    """More than three words in ten end with an exclamation mark."""
    return 10 * texts.words_per_row(texts.buf[texts.words()[1] - 1] == 33) > 3 * texts.n_words()


def odd_word_length(texts: Texts) -> np.ndarray:
    """Words have less than 2 or more than 20 characters on average."""
    chars, n = word_chars(texts), texts.n_words()
    return (chars < 2 * n) | (chars > 20 * n)


def letterless(texts: Texts) -> np.ndarray:
    """More than two words in five have neither a letter A to Z nor another alphabet's character."""
    run = np.concatenate(([0], np.cumsum(VISIBLE[texts.buf], dtype=np.int64)))
    starts, ends, _ = texts.words()
    return 5 * texts.words_per_row(run[ends] == run[starts]) > 2 * texts.n_words()


def one_word(texts: Texts) -> np.ndarray:
    """One word makes up more than three words in ten."""
    hashes, rows = texts.hashes(), texts.row_of_word()
    order = np.lexsort((hashes, rows))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    heads = np.flatnonzero(new)
    most = np.zeros(texts.rows, np.int64)
    np.maximum.at(most, rows[order][heads], np.diff(np.append(heads, len(order))))
    return 10 * most > 3 * texts.n_words()


def stuttering(texts: Texts) -> np.ndarray:
    """More than three words in ten equal the word before."""
    hashes, rows = texts.hashes(), texts.row_of_word()
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    return 10 * texts.words_per_row(same) > 3 * texts.n_words()


Rule = Callable[[Texts], np.ndarray]
RULES: dict[str, Rule] = {
    f.__name__: f for f in (
        many_symbols, many_dup_lines, shouting, exclaiming, odd_word_length, letterless, one_word, stuttering)}


def passes(texts: Texts, order: list[str], rules: dict[str, Rule]) -> np.ndarray:
    """The rows that pass all rules; each rule sees only what the earlier ones kept."""
    left = np.arange(texts.rows)
    for name in order:
        if not len(left):
            break
        kept = np.flatnonzero(~rules[name](texts))
        left, texts = left[kept], texts.take(kept)
    return left


def rule_order(docs: DataFrame, rules: dict[str, Rule], id_col: str, text_col: str) -> list[str]:
    """Rule names by rejections per second on the sample, most first."""
    names = list(rules)
    ids = docs.select(F.col(id_col).alias("id")).distinct().orderBy(
        F.xxhash64(F.lit(5), "id"), "id").limit(SAMPLE_ROWS)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in arrays.slices(batch.column(1)):
                rejected, seconds = [], []
                for name in names:
                    texts, began = Texts(buf, offsets), time.perf_counter()
                    rejected.append(int(rules[name](texts).sum()))
                    seconds.append(time.perf_counter() - began)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(rejected, pa.int64()), pa.array(seconds)],
                    names=["rule", "rejected", "seconds"])

    found = sample.mapInArrow(run, "rule string, rejected long, seconds double").groupBy("rule").agg(
        F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect()
    gain = {row["rule"]: row["rejected"] / max(row["seconds"], 1e-9) for row in found}
    return sorted(names, key=lambda name: (-gain.get(name, 0.0), names.index(name)))


def rate_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict[str, Rule] | None = None
) -> DataFrame:
    """Counts of every text, whether it fails the base rules, and the cascade's verdict ``kept``."""
    rules = rules or RULES
    order = rule_order(docs, rules, id_col, text_col)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = "id long, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in arrays.slices(batch.column(1)):
                texts = Texts(buf, offsets)
                n, repeats = texts.n_words(), repeat_words(texts)
                failed = (n < 50) | (100 * repeats > 50 * n)
                kept = np.zeros(len(n), bool)
                able = np.flatnonzero(~failed)
                kept[able[passes(texts.take(able), order, rules)]] = True
                values = (n, word_chars(texts), symbols(texts), dup_lines(texts), repeats)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     *[pa.array(v.astype(np.int64)) for v in values], pa.array(failed), pa.array(kept)],
                    names=["id", *counts, "base_failed", "kept"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)

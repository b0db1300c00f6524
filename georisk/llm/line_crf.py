"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines
before and after it; a chain ties neighbouring labels. The field is fitted on at
most ``FIT_DOCUMENTS`` labelled documents (the stated bound; their lines all
carry the document's label), chosen by a hash of their ids. Scoring runs
forward-backward on every line of every text, and the marginals, weighted by
line length, add up to the document's score.

Defined cases: a null or empty text is one empty line and gets a score as well;
labels that are null are not used, several labels of one document count as
their maximum; without labels of both kinds every score is 0.5; a null
``doc_id`` is never used for fitting and not held out; an empty table gives no
rows; extra columns are ignored by ``score_quality`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from georisk.llm import arrays

FIT_DOCUMENTS, STEPS, PENALTY = 4000, 200, 0.1
SLICE = 1 << 18
FEATURES = 18


def _byte_class(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text.encode())] = True
    return out


UPPER, DIGIT = _byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _byte_class("0123456789")
LOWER, SYMBOL = _byte_class("abcdefghijklmnopqrstuvwxyz"), _byte_class("#*$%&<>@^~={}[]\\_")
BANG, PIPE, MARK = _byte_class("!?"), _byte_class("|"), _byte_class(".,;:")
CODE = _byte_class("/(){};=\"'+-")
WIDE = np.arange(256) >= 128


def line_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and the number of lines before each row."""
    breaks = np.flatnonzero(buf == 10)
    row_of = np.searchsorted(offsets, breaks, "right") - 1
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    lines = np.bincount(row_of, minlength=len(offsets) - 1) + 1
    bounds = np.concatenate(([0], np.cumsum(lines)))
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[bounds[1:] - 1] = offsets[1:]
    return starts, ends, bounds


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    run = np.concatenate(([0], np.cumsum(flags)))
    return (run[ends] - run[starts]).astype(np.float64)


def _repeated(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a value comes at least twice in its row."""
    order = np.lexsort((values, rows))
    same = np.zeros(len(values), bool)
    equal = (values[order][1:] == values[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    flags = np.zeros(len(values), bool)
    flags[1:] |= equal
    flags[:-1] |= equal
    same[order] = flags
    return same


def line_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, line lengths, lines before each row) of a slice of texts."""
    starts, ends, bounds = line_spans(buf, offsets)
    n = len(starts)
    size = (ends - starts).astype(np.float64)
    total = np.maximum(size, 1)
    out = np.zeros((n, FEATURES), np.float32)
    begin, stop, at = arrays.words(buf, offsets)
    hashes = arrays.span_hashes(buf, begin, stop)
    line_of = np.searchsorted(starts, begin, "right") - 1
    # Empty lines share their start with the next line: the last of them is the one with words.
    many = np.bincount(line_of, minlength=n).astype(np.float64)
    some = np.maximum(many, 1)
    letters = np.maximum(_sums(UPPER[buf] | LOWER[buf], starts, ends), 1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    next_same = np.zeros(len(hashes), bool)
    next_same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    fresh = np.zeros(len(hashes), bool)
    if len(hashes):
        order = np.lexsort((hashes, line_of))
        first = np.ones(len(order), bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line_of[order][1:] != line_of[order][:-1])
        fresh[order] = first
    grams, whole = arrays.windows(hashes, at, 3)
    twice = np.zeros(len(hashes), bool)
    if whole.any():
        twice[np.flatnonzero(whole)] = _repeated(grams[whole], rows[whole])
    lengths = stop - begin
    tails = buf[np.maximum(stop - 1, 0)] if len(stop) else np.empty(0, np.uint8)
    line_hash = np.zeros(n, np.uint64)
    if len(hashes):
        heads = np.flatnonzero(np.diff(line_of, prepend=-1))
        fold = np.add.reduceat(arrays.mix(hashes + np.arange(len(hashes), dtype=np.uint64) - np.repeat(
            heads, np.diff(np.append(heads, len(hashes)))).astype(np.uint64)), heads)
        line_hash[line_of[heads]] = fold
    doc_of = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    per = lambda flags: np.bincount(line_of[flags], minlength=n) / some
    columns = [
        np.ones(n), np.minimum(np.log1p(many) / 5, 2), (many == 0), (many > 0) & (many < 4),
        _sums(UPPER[buf], starts, ends) / letters, _sums(SYMBOL[buf], starts, ends) / total,
        _sums(BANG[buf], starts, ends) / total, _sums(DIGIT[buf], starts, ends) / total,
        per(PIPE[tails] & (lengths == 1)), _sums(CODE[buf], starts, ends) / total,
        _sums(WIDE[buf], starts, ends) / total, per(MARK[tails]),
        np.bincount(line_of, weights=lengths, minlength=n) / some / 10, 1 - per(fresh),
        per(next_same), per(twice), (many > 0) & _repeated(line_hash, doc_of),
        per(BANG[tails] | SYMBOL[tails]),
    ]
    for i, column in enumerate(columns):
        out[:, i] = np.minimum(column, 4)
    return out, size, bounds


class Chains:
    """Sequences of lines, longest first, so that step t works on a prefix of them."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        order = np.argsort(-lengths, kind="stable")
        self.first, self.lengths = bounds[:-1][order], lengths[order]
        most = int(self.lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(most), "left")

    def run(self, logit: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Forward and backward log odds of each line, its log odds, and the log partition sum."""
        (t00, t01), (t10, t11) = tie
        ahead, behind = np.zeros(len(logit)), np.zeros(len(logit))
        whole = np.zeros(len(self.first))
        for t, m in enumerate(self.active):
            here = self.first[:m] + t
            if t == 0:
                ahead[here] = logit[here]
            else:
                last = ahead[here - 1]
                low = np.logaddexp(t00, t10 + last)
                whole[:m] += low
                ahead[here] = logit[here] + np.logaddexp(t01, t11 + last) - low
        for t in range(len(self.active) - 2, -1, -1):
            m = self.active[t + 1]
            here = self.first[:m] + t
            after = logit[here + 1] + behind[here + 1]
            behind[here] = np.logaddexp(t10, t11 + after) - np.logaddexp(t00, t01 + after)
        ends = self.first + self.lengths - 1
        whole = whole + np.logaddexp(0, ahead[ends])
        return ahead, behind, ahead + behind, float(whole.sum())


def _shifted(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the line before and of the line after; 0 beyond the ends of a text."""
    before, after = np.zeros_like(values), np.zeros_like(values)
    before[1:], after[:-1] = values[:-1], values[1:]
    before[bounds[:-1]] = 0
    after[bounds[1:] - 1] = 0
    return before, after


def logits(features: np.ndarray, bounds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    own, before, after = weights.reshape(3, FEATURES)
    own_part = features @ own
    return own_part + _shifted(features @ before, bounds)[0] + _shifted(features @ after, bounds)[1]


def fit(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the field by penalised conditional likelihood; last four tie neighbours."""
    chains, y = Chains(bounds), np.repeat(labels, np.diff(bounds)).astype(np.float64)
    features = features.astype(np.float64)
    inner = np.ones(len(y), bool)
    inner[bounds[:-1]] = False
    inner = np.flatnonzero(inner)
    before, after = _shifted(features, bounds)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        weights, tie = theta[:-4], theta[-4:].reshape(2, 2)
        logit = logits(features, bounds, weights)
        ahead, behind, odds, whole = chains.run(logit, tie)
        chosen = (logit * y).sum() + tie[y[inner - 1].astype(int), y[inner].astype(int)].sum()
        rest = y - 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        grad = np.concatenate([rest @ features, rest @ before, rest @ after])
        right = logit[inner] + behind[inner]
        left = ahead[inner - 1]
        pair = np.stack([tie[i, j] + i * left + j * right for i in (0, 1) for j in (0, 1)])
        pair -= pair.max(0)
        pair = np.exp(pair)
        pair /= pair.sum(0)
        seen = np.bincount(2 * y[inner - 1].astype(int) + y[inner].astype(int), minlength=4)
        return (whole - chosen + PENALTY * (theta @ theta) / 2,
                np.concatenate([-grad, pair.sum(1) - seen]) + PENALTY * theta)

    return minimise(loss, np.zeros(3 * FEATURES + 4), STEPS)


def minimise(loss, start: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with step halving."""
    x, (value, grad) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, scales = grad.copy(), []
        for s, y in reversed(moves):
            scales.append((s @ direction) / (s @ y))
            direction -= scales[-1] * y
        if moves:
            s, y = moves[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(1.0, np.linalg.norm(grad))
        for (s, y), scale in zip(moves, reversed(scales)):
            direction += s * (scale - (y @ direction) / (s @ y))
        size = 1.0
        while size > 1e-6:
            there = x - size * direction
            new, slope = loss(there)
            if new <= value - 1e-4 * size * (grad @ direction):
                break
            size /= 2
        else:
            break
        s, y = there - x, slope - grad
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        done = value - new < 1e-7 * abs(value)
        x, value, grad = there, new, slope
        if done:
            break
    return x


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(parts)


def fit_sample(
    docs: DataFrame, labels: DataFrame, label: str, training: Column, most: int, id_col: str, text_col: str
) -> DataFrame:
    """(text, y) of at most ``most`` labelled training documents, the first by a hash of their ids."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(training)
    chosen = known.orderBy(F.xxhash64(F.lit(11), "id"), "id").limit(most)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "y")


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int = FIT_DOCUMENTS) -> np.ndarray | None:
    sample = fit_sample(docs, labels, "quality", fold("id", 5) != 0, most, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in arrays.slices(batch.column("text"), SLICE):
                features, _, bounds = line_features(buf, offsets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(first, last - first), batch.column("y").slice(first, last - first),
                    arrays.binaries(features.reshape(-1), bounds * FEATURES)], names=["id", "y", "features"])

    rows = sample.mapInArrow(run, "id long, y int, features binary").toArrow().sort_by("id")
    y = rows.column("y").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    parts = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in rows.column("features").to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
    return fit(np.concatenate(parts), bounds, y)


def scored(buf: np.ndarray, offsets: np.ndarray, theta: np.ndarray | None) -> np.ndarray:
    """Scores of a slice of texts: line marginals weighted by line length."""
    if theta is None:
        return np.full(len(offsets) - 1, 0.5)
    features, size, bounds = line_features(buf, offsets)
    _, _, odds, _ = Chains(bounds).run(
        logits(features.astype(np.float64), bounds, theta[:-4]), theta[-4:].reshape(2, 2))
    good, weight = 1 / (1 + np.exp(-np.clip(odds, -500, 500))), size + 1
    return np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    theta = train(docs, labels, id_col, text_col)
    own = ("held_out", "score", "predicted")
    base = docs.select(*[c for c in docs.columns if c not in own])
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, buf, offsets in arrays.slices(batch.column(text_col), SLICE):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scored(buf, offsets, theta))], names=[*names, "score"])

    schema = base.withColumn("score", F.lit(0.0)).schema
    rows = base.mapInArrow(run, schema)
    return rows.select(
        *names, F.coalesce(fold(id_col, 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the field does not reject; columns unchanged."""
    rated = score_quality(docs, labels, id_col, text_col)
    return rated.where("predicted = 1").select(*docs.columns)

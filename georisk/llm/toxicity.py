"""Toxicity of texts after noisy-channel deobfuscation.

Spans that look disguised (digits or signs among letters, letters set apart,
letters drawn out) become lattices of what each character may stand for. A
Viterbi search under a character language model, whose counts come from all
words of the corpus, picks the most likely reading, and the restored text is
scored. The score weighs words and word beginnings that labelled toxic texts use
much more often than clean ones; a logistic model turns the sum into a score.

Fitting uses at most ``FIT_DOCUMENTS`` labelled documents of each kind (the
stated bound), chosen by a hash of their ids, one of each group of near copies.

Defined cases: a null or empty text has no words and gets a score as well;
labels that are null are not used, several labels of one document count as
their maximum; without labels of both kinds every score is 0.5; a null
``doc_id`` is never used for fitting and not held out; documents are scored row
by row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from georisk.llm import arrays
from georisk.llm.line_crf import fold, minimise
from georisk.workspace import settle

FIT_DOCUMENTS = 4000
LEAST_DOCUMENTS, LEAST_RATIO = 5, 1.8
PREFIXES = (4, 5, 6, 7)
MEMO, LONG_TOKEN = 200_000, 64

# What signs commonly stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "¡": "i", "ø": "o",
}
SEPARATORS = " \t.-_*~'`^,/\\"
# Costs of the channel in nats.
SUBSTITUTE, DROP_SEPARATOR, DROP_REPEAT, UNSEEN = 0.7, 0.5, 0.6, 14.0
EDGE, OTHER = "^", "\x00"

_SIGN = re.escape("".join(STANDS_FOR))
_LETTER = r"[^\W\d_]"
_APART = rf"(?<![\w{_SIGN}])(?:[\w{_SIGN}][{re.escape(SEPARATORS)}]{{1,2}}){{3"
DISGUISED = re.compile(
    # single characters set apart
    rf"{_APART},}}[\w{_SIGN}](?![\w{_SIGN}])"
    # letters with signs among or before them
    rf"|(?<![\w{_SIGN}])(?=[\w{_SIGN}]*[{_SIGN}][\w{_SIGN}]*{_LETTER})[\w{_SIGN}]*{_LETTER}[\w{_SIGN}]*(?<![!|])"
    # a letter three times or more
    rf"|{_LETTER}*({_LETTER})\1\1{_LETTER}*")
# How every span of single characters set apart begins.
APART = re.compile(_APART + "}")
WORD = re.compile(_LETTER + "+")
# Around a token of letters these change nothing; they are neither letters nor signs.
PLAIN_EDGES = ".,;:?\"()[]{}'-"
TRIPLED = re.compile(r"(.)\1\1")
DOUBLED = re.compile(r"(.)\1")
RUN = re.compile(r"(.)\1+")


class Memo:
    """Answers to the latest questions: a full half takes the place of the older one."""

    def __init__(self, ask: Callable, most: int = MEMO):
        self.ask, self.most = ask, most
        self.new: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        known = self.new.get(key)
        if known is None:
            known = self.old.get(key)
            if known is None:
                known = self.ask(key)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[key] = known
        return known


# --- tokens of a batch

_SOLID, _SEPARATOR, _INNER = 1, 2, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[128:] = _SOLID  # any part of a longer character may be one of a letter or sign
_KINDS[128:192] |= _INNER
for _c in map(chr, range(128)):
    _KINDS[ord(_c)] |= (_SOLID if _c == "_" or _c.isalnum() or _c in STANDS_FOR else 0) | (_SEPARATOR if _c in SEPARATORS else 0)


def may_be_apart(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold what ``APART`` finds: three single characters in a row, one or two separators between.

    Works on bytes and takes every byte beyond ASCII for a letter, so it never
    misses a row; ``APART`` itself decides on the rows it names.
    """
    out = np.zeros(len(offsets) - 1, bool)
    kinds = _KINDS[buf]
    head = (kinds & _INNER) == 0
    place = np.flatnonzero(head)
    if len(place) < 6:
        return out
    solid, separates = (kinds[place] & _SOLID) > 0, (kinds[place] & _SEPARATOR) > 0
    # A character that can stand alone: the next one separates.
    single = np.flatnonzero(solid[:-1] & separates[1:])
    if len(single) < 3:
        return out
    # The next single one comes after one or two separators. The underscore is of both kinds, so
    # what lies between is not looked at again.
    near = np.diff(single) <= 3
    found = place[single[np.flatnonzero(near[:-1] & near[1:])]]
    out[np.searchsorted(offsets, found, "right") - 1] = True
    return out


def distinct_tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens of a slice in lower case, the token of each occurrence, and the occurrences before each row."""
    starts, ends, bounds = arrays.words(buf, offsets)
    _, first, which = np.unique(arrays.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    raw = buf.tobytes()
    tokens = [raw[a:b].decode().lower() for a, b in zip(starts[first].tolist(), ends[first].tolist())]
    return tokens, which, bounds


# --- character language model

def char_of(c: str) -> str:
    """Latin letters stand for themselves, all others share one symbol."""
    return c if c < "ɐ" else OTHER


def word_table(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) of all words of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many: Counter[str] = Counter()
        for batch in batches:
            for _, _, buf, offsets in arrays.slices(batch.column(0)):
                tokens, which, _ = distinct_tokens(buf, offsets)
                for token, n in zip(tokens, np.bincount(which, minlength=len(tokens)).tolist()):
                    for word in (token,) if token.isalpha() else WORD.findall(token):
                        many[word] += n
                if len(many) > MEMO:
                    yield counted(many)
                    many = Counter()
        yield counted(many)

    def counted(many: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(many), pa.string()), pa.array(list(many.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def char_model(words: DataFrame) -> dict[str, float]:
    """Costs of a character after the two before it; '' holds the cost of unseen ones.

    Words are long-tailed, so the table of words grows with the corpus; what
    comes to the driver is bounded by the triples of Latin letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many: Counter[str] = Counter()
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                line = EDGE * 2 + "".join(map(char_of, word)) + EDGE
                for i in range(len(line) - 2):
                    many[line[i:i + 3]] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(many), pa.string()), pa.array(list(many.values()), pa.int64())], names=["gram", "n"])

    rows = words.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    seen, before, single, after = Counter(), Counter(), Counter(), Counter()
    for row in rows:
        gram, n = row["gram"], row["n"]
        seen[gram] += n
        before[gram[:2]] += n
        single[gram[1:]] += n
        after[gram[1]] += n
    costs = {}
    for gram, n in seen.items():
        # Interpolated with the pair, so that a rare triple of a common pair stays cheap.
        pair = single[gram[1:]] / max(1, after[gram[1]])
        costs[gram] = -math.log(0.85 * n / before[gram[:2]] + 0.15 * pair)
    return costs


class Reader:
    """Most likely readings of disguised spans."""

    def __init__(self, costs: dict[str, float]):
        self.costs = costs
        self.read = Memo(self.decode)

    def cost(self, a: str, b: str, c: str) -> float:
        return self.costs.get(a + b + c, UNSEEN)

    def decode(self, span: str) -> str:
        """Viterbi over (two last letters, last source character) of the lattice of a span."""
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {(EDGE, EDGE): (0.0, None)}
        for place, char in enumerate(span):
            following: dict[tuple[str, str], tuple[float, tuple | None]] = {}

            def offer(state: tuple[str, str], price: float, path: tuple | None) -> None:
                known = following.get(state)
                if known is None or price < known[0]:
                    following[state] = (price, path)

            again = place > 0 and span[place - 1] == char
            letters = STANDS_FOR.get(char, "")
            for (a, b), (price, path) in states.items():
                if char in SEPARATORS:
                    # Either the word goes on, or it ends here.
                    offer((a, b), price + DROP_SEPARATOR, path)
                    end = 0.0 if b == EDGE else self.cost(a, b, EDGE)
                    offer((EDGE, EDGE), price + end, (path, " "))
                    continue
                if again and b == char_of(char) or again and b in letters:
                    offer((a, b), price + DROP_REPEAT, path)
                options = [(char, 0.0)] if char.isalpha() else []
                options += [(letter, SUBSTITUTE) for letter in letters]
                if not options:
                    options = [(char, UNSEEN)]
                for letter, extra in options:
                    shown = char_of(letter)
                    offer((b, shown), price + extra + self.cost(a, b, shown), (path, letter))
            states = following
        best = min(
            ((price + (0.0 if b == EDGE else self.cost(a, b, EDGE)), path) for (a, b), (price, path) in states.items()),
            key=lambda x: x[0])[1]
        out = []
        while best is not None:
            best, letter = best
            out.append(letter)
        return "".join(reversed(out))

    def restore(self, text: str) -> str:
        """The text in lower case, its disguised spans read."""
        return DISGUISED.sub(lambda match: self.read(match.group()), text.lower())


# --- evidence

def marks(word: str) -> list[str]:
    """What a word can be known by: itself and its beginnings."""
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) > n)]


def fit_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, y) of labelled training documents, FIT_DOCUMENTS of each kind at most."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg(F.max("y").alias("y")).where(fold("id", 3) != 1)
    chosen = None
    for kind in (0, 1):
        part = known.where(F.col("y") == kind).orderBy(F.xxhash64(F.lit(13), "id"), "id").limit(FIT_DOCUMENTS)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "y")


def restored_sample(sample: DataFrame, costs: dict[str, float]) -> DataFrame:
    """(id, y, words) of the sample, one document of each group of near copies."""
    table = sample.sparkSession.sparkContext.broadcast(costs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(table.value)
        for batch in batches:
            texts = [reader.restore(t or "") for t in batch.column(1).to_pylist()]
            least = []
            for _, _, buf, offsets in arrays.slices(pa.array(texts, pa.string())):
                hashes, bounds = arrays.word_hashes(buf, offsets)
                values, at = arrays.shingles(hashes, bounds, 5)
                least += [int(values[a:b].min()) >> 1 if b > a else -1 for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(least, pa.int64()),
                 pa.array([WORD.findall(t) for t in texts], pa.list_(pa.string()))], names=["id", "y", "least", "words"])

    rows = sample.mapInArrow(run, "id long, y int, least long, words array<string>")
    # Near copies mostly share their smallest shingle.
    first = settle(rows, "toxic_sample")
    keep = first.groupBy("least", "y").agg(F.min("id").alias("id"))
    return first.join(keep, ["least", "y", "id"]).dropDuplicates(["id"])


def lexicon(sample: DataFrame) -> tuple[dict[str, tuple[int, int, int]], tuple[int, int]]:
    """mark -> (toxic documents, toxic uses, clean uses) of telling marks; words of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many: dict[str, list[int]] = {}
        for batch in batches:
            for y, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                uses: Counter[str] = Counter()
                for word, n in Counter(words).items():
                    for mark in marks(word):
                        uses[mark] += n
                uses[""] = len(words)
                for mark, n in uses.items():
                    entry = many.setdefault(mark, [0, 0, 0])
                    if y:
                        entry[0] += 1
                        entry[1] += n
                    else:
                        entry[2] += n
        values = list(many.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(many), pa.string()), *[pa.array([v[i] for v in values], pa.int64()) for i in range(3)]],
            names=["mark", "docs", "toxic", "clean"])

    rows = settle(sample.select("y", "words").mapInArrow(run, "mark string, docs long, toxic long, clean long").groupBy(
        "mark").agg(*[F.sum(c).alias(c) for c in ("docs", "toxic", "clean")]), "marks")
    whole = rows.where("mark = ''").first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return {}, (0, 0)
    words = (whole["toxic"], whole["clean"])
    odds = F.log((F.col("toxic") + 0.1) / words[0]) - F.log((F.col("clean") + 0.5) / words[1])
    # Marks of LEAST_DOCUMENTS of the fitted documents: their number is bounded with the sample.
    chosen = rows.where(F.col("docs") >= LEAST_DOCUMENTS).where("mark <> ''").where(odds >= LEAST_RATIO)
    return {r["mark"]: (r["docs"], r["toxic"], r["clean"]) for r in chosen.collect()}, words


Told = tuple[int, tuple[tuple[str, float], ...]]


def gathered(tokens: Iterable[tuple[Told, int]]) -> list[tuple[float, int]]:
    """(weight, uses) of each telling word of some tokens and their uses."""
    found: dict[str, tuple[float, int]] = {}
    for (_, told), n in tokens:
        for word, weight in told:
            found[word] = (weight, found[word][1] + n if word in found else n)
    return list(found.values())


class Scale:
    """Evidence of words: the log odds of their most telling mark."""

    def __init__(self, entries: dict[str, tuple[int, int, int]], words: tuple[int, int]):
        self.entries, self.words = entries, words
        # Beginnings of all marks: most words have none of them and are done with one look.
        self.heads = {mark.removeprefix("=")[:PREFIXES[0]] for mark in entries}

    def odds(self, docs: int, toxic: int, clean: int) -> float:
        if docs < LEAST_DOCUMENTS or toxic <= 0:
            return 0.0
        value = math.log((toxic + 0.1) / self.words[0]) - math.log((clean + 0.5) / self.words[1])
        return value if value >= LEAST_RATIO else 0.0

    def weight(self, word: str) -> float:
        if word[:PREFIXES[0]] not in self.heads:
            return 0.0
        return max((self.odds(*self.entries[m]) for m in marks(word) if m in self.entries), default=0.0)

    def token(self, token: str, reader: Reader, restored: bool = False) -> Told:
        """Restored words of a token: their number, and those that speak for toxicity."""
        plain = token.strip(PLAIN_EDGES)
        words = None
        if plain.isalpha() and "ø" not in plain:
            if not DOUBLED.search(plain):
                weight = self.weight(plain)
                return 1, ((plain, weight),) if weight else ()
            if not TRIPLED.search(plain):
                words = (plain,)  # nothing in it can be disguised
        if words is None:
            words = WORD.findall(token if restored else reader.restore(token))
        told = []
        for word in words:
            weight = self.weight(word)
            if not weight and DOUBLED.search(word) and self.weight(RUN.sub(r"\1", word)):
                word = reader.decode(word)
                weight = self.weight(word)
            if weight:
                told.append((word, weight))
        return len(words), tuple(told)

    def telling(self, text: str, reader: Reader) -> tuple[list[tuple[float, int]], int]:
        """(weight, uses) of the telling words of a text, restored as a whole, and its number of words."""
        many = Counter(reader.restore(text).split())
        known = {token: self.token(token, reader, True) for token in many}
        return gathered((known[token], n) for token, n in many.items()), sum(known[t][0] * n for t, n in many.items())

    def without(self, uses: Counter[str], y: int) -> list[tuple[float, int]]:
        """As ``telling``, as if the document itself had not been counted."""
        own: Counter[str] = Counter()
        for word, n in uses.items():
            for mark in marks(word):
                if mark in self.entries:
                    own[mark] += n
        out = []
        for word, n in uses.items():
            best = 0.0
            for mark in marks(word):
                if mark in self.entries:
                    docs, toxic, clean = self.entries[mark]
                    best = max(best, self.odds(docs - y, toxic - y * own[mark], clean - (1 - y) * own[mark]))
            if best:
                out.append((best, n))
        return out


def evidence(found: list[tuple[float, int]], words: int) -> list[float]:
    """Numbers that the logistic model weighs."""
    total = sum(weight * n for weight, n in found)
    best = sorted((weight * math.log1p(n) for weight, n in found), reverse=True)
    long = math.log1p(words)
    return [1.0, long / 5, math.log1p(total), math.log1p(total) * long / 5, total / (1 + words) * 10,
            (best[0] if best else 0.0) / 5, math.log1p(len(found)), sum(best[:3]) / 10]


def fit_weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        z = x @ theta
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return float(np.logaddexp(0, z).sum() - y @ z + theta @ theta / 20), x.T @ (p - y) + theta / 10

    return minimise(loss, np.zeros(x.shape[1]), 300)


class Model:
    """All that scoring needs, bounded by its parameters."""

    def __init__(self, costs: dict, entries: dict, words: tuple[int, int], theta: np.ndarray | None):
        self.costs, self.entries, self.words, self.theta = costs, entries, words, theta

    def scorer(self) -> Callable[[pa.Array], list[float]]:
        """Scores of a column of texts.

        Only single characters set apart can reach over blanks and need the whole
        text; all other disguises lie within a token, so each distinct token of a
        slice is restored and weighed once.
        """
        reader, scale = Reader(self.costs), Scale(self.entries, self.words)
        short = Memo(lambda token: scale.token(token, reader))

        def logistic(found: list[tuple[float, int]], words: int) -> float:
            x = evidence(found, words)
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, float(np.dot(self.theta, x))))))

        def score(column: pa.Array) -> list[float]:
            out: list[float] = []
            for first, last, buf, offsets in arrays.slices(column):
                if self.theta is None:
                    out += [0.5] * (last - first)
                    continue
                tokens, which, bounds = distinct_tokens(buf, offsets)
                latest = short.new
                known = [latest.get(t) or (short(t) if len(t) < LONG_TOKEN else scale.token(t, reader)) for t in tokens]
                sizes = np.fromiter((k[0] for k in known), np.int64, len(known))
                tells = np.fromiter((bool(k[1]) for k in known), bool, len(known))
                before = np.concatenate(([0], np.cumsum(sizes[which])))
                telling = np.flatnonzero(tells[which])
                at = np.searchsorted(telling, bounds)
                whole = may_be_apart(buf, offsets)
                for row in range(last - first):
                    if whole[row]:
                        text = column[first + row].as_py().lower()
                        if APART.search(text):
                            out.append(logistic(*scale.telling(text, reader)))
                            continue
                    uses = Counter(which[telling[at[row]:at[row + 1]]].tolist())
                    words = int(before[bounds[row + 1]] - before[bounds[row]])
                    out.append(logistic(gathered((known[t], n) for t, n in uses.items()), words))
            return out

        return score


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    costs = char_model(word_table(docs, text_col))
    sample = settle(restored_sample(fit_sample(docs, labels, id_col, text_col), costs), "toxic_words")
    entries, words = lexicon(sample)
    if not words[0]:
        return Model(costs, {}, (1, 1), None)
    spread = sample.sparkSession.sparkContext.broadcast((entries, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = Scale(*spread.value)
        for batch in batches:
            y = batch.column(1).to_pylist()
            uses = [Counter(w) for w in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.array([evidence(scale.without(u, k), sum(u.values())) for u, k in zip(uses, y)],
                         pa.list_(pa.float64()))], names=["id", "y", "x"])

    rows = sample.select("id", "y", "words").mapInArrow(run, "id long, y int, x array<double>").toArrow().sort_by("id")
    x = np.array(rows.column("x").to_pylist(), np.float64)
    return Model(costs, entries, words, fit_weights(x, rows.column("y").to_numpy().astype(np.float64)))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.value.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score(batch.column(1)), pa.float64())],
                names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, score double")
    return rows.select(
        F.col("id").alias(id_col), F.coalesce(fold("id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Spelling variants, fill in the middle and repeated bytes against brute force, and odd inputs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from georisk.llm import fill_middle as fm
from georisk.llm import spelling as sp
from georisk.llm import suffix_dedup as sd
from tests.llm.conftest import ODD_ROWS

TEXTS = "doc_id long, text string"


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


# --- spelling ----------------------------------------------------------------------

def brute_words(rows, least=5, every=97, min_count=3):
    counts = Counter()
    for key, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def variants(df, **settings):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in sp.spelling_variants(df, **settings).collect()}


def many_words(seed=3):
    """Dense words: few letters, many lengths, Zipf-like counts, umlauts and capitals."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(4, 9))) for _ in range(400)]
    words += ["x" * 30, "x" * 31, "x" * 29 + "y", "Größe", "größe", "grösse", "ÀÁÂÃÄ", "àáâãä"]
    return [(i, " ".join(draw.choice(words[:1 + int(len(words) * draw.random() ** 2)]) for _ in range(120)) + ", "
             + draw.choice(words)) for i in range(60)]


def test_variants_equal_brute_force(spark, monkeypatch):
    rows = many_words()
    expected = brute_variants(brute_words(rows))
    assert len(expected) > 200 and sum(x[3] > 0 for x in expected.values()) > 100
    docs = spark.createDataFrame(rows, TEXTS)
    assert variants(docs) == expected
    # Small groups, blocks and parts: every group is split to the last place.
    monkeypatch.setattr(sp, "GROUP", 2)
    monkeypatch.setattr(sp, "BLOCK", 4)
    monkeypatch.setattr(sp, "PART_ROWS", 50)
    monkeypatch.setattr(sp, "COUNTED", 10)
    assert variants(docs) == expected


def test_variants_of_one_stem(spark):
    """A third of all words share one end: groups are split and no pair is lost."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a}{b}{c}ending" for a in letters[:9] for b in letters[:9] for c in letters[:9]]
    words += [f"starting{a}{b}" for a in letters for b in letters]
    rows = [(i, f"{w} {w} {w} " * (1 + i % 3)) for i, w in enumerate(words)]
    found = variants(spark.createDataFrame(rows, TEXTS), every=1 << 40)
    counts = {w: 3 * (1 + i % 3) for i, w in enumerate(words)}
    assert {w: x[2] for w, x in found.items()} == counts
    assert all(found[w][3] == 24 for w in words if w.endswith("ending"))
    assert all(found[w][3] == 50 for w in words if w.startswith("starting"))


def test_long_words_and_odd_rows(spark, odd_docs, no_docs):
    long = "ab" * 4000
    rows = [(1, f"{long} {long} {long} {long[:-1]} {long[:-1]} {long[:-1]}"), (None, None), (None, "Words words WORDS"), (2, "")]
    expected = brute_variants(brute_words(rows))
    assert expected[long][3] == 1
    assert variants(spark.createDataFrame(rows, TEXTS)) == expected
    assert variants(odd_docs) == brute_variants(brute_words([r[:2] for r in ODD_ROWS]))
    assert variants(no_docs) == {}


# --- fill in the middle ---------------------------------------------------------------

def brute_middle(key, text, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("settings", [{}, {"rate": 40, "spm_rate": 90}])
def test_middle_equals_brute_force(spark, settings):
    draw = random.Random(8)
    rows = [(i, "".join(draw.choice(["a", "é", "\n", "日", "\r", "\x85", "<", "S>", " ", "<P"]) for _ in range(draw.randint(0, 200))))
            for i in range(300)]
    docs = spark.createDataFrame(rows, TEXTS)
    found = fm.fill_in_middle(docs, **settings).withColumn("back", fm.restored()).collect()
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_middle(r["doc_id"], r["text"], **settings)
        assert r["back"] == r["text"]


def test_skip_list_reaches_every_rank():
    draw = random.Random(4)
    for n in (1, 2, 3, 4, 5, 6, 17, 1000):
        lengths = np.array([draw.randint(1, 9) for _ in range(n)])
        lanes = fm.LaneList(lengths)
        before = [0, *np.cumsum(lengths).tolist()]
        assert [lanes.place(rank) for rank in range(n + 1)] == before
    assert len(fm.LaneList(np.ones(100_000, np.int64)).lanes) < 40


def test_middle_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("output", F.lit("x")).withColumn("form", F.lit("x"))
    found = fm.fill_in_middle(docs).withColumn("back", fm.restored()).collect()
    assert len(found) == len(ODD_ROWS) and "kept" in docs.columns and found[0]["kept"] == "x"
    for r in found:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute_middle(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert fm.fill_in_middle(no_docs).count() == 0


# --- repeated bytes ----------------------------------------------------------------------

def brute_repeats(rows, length=100):
    rows = [(key, (text or "").encode()) for key, text in rows]
    seen, out = set(), {}
    for key, body in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            window = body[i:i + length]
            if window in seen:
                gone[i:i + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(body, "u1")[~gone])
        runs = int((np.diff(np.concatenate(([False], gone))) & gone).sum())
        out[key] = (len(body), int(gone.sum()), runs, kept)
    return out


def repeats(df, **settings):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sd.drop_repeats(df, **settings).collect()}


def repeated_rows(seed=11, docs=120):
    """Passages, copies, near copies, periods and accents."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeéñ") for _ in range(draw.randint(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (20, 30, 60, 200, 25, 26)]
    rows = []
    for i in range(docs):
        parts = [" ".join(word() for _ in range(draw.randint(0, 60))) for _ in range(draw.randint(1, 4))]
        parts.insert(draw.randint(0, len(parts)), draw.choice(passages))
        if draw.random() < 0.2:
            parts.append(draw.choice(["a" * 350, "ab " * 120, "x" * 99, "é" * 50]))
        if draw.random() < 0.2 and rows:
            parts = [rows[draw.randrange(len(rows))][1].replace("b", "c", draw.randint(0, 1))]
        rows.append((i * 7 % docs, " ".join(parts)))
    return rows


def test_repeats_equal_brute_force(spark):
    rows = repeated_rows()
    expected = brute_repeats(rows)
    assert sum(x[1] > 0 for x in expected.values()) > 40
    docs = spark.createDataFrame(rows, TEXTS).repartition(5)
    assert repeats(docs) == expected
    assert repeats(docs, length=150) == brute_repeats(rows, 150)


def test_repeats_do_not_depend_on_how_work_is_cut(spark, monkeypatch):
    rows = repeated_rows(12, 60)
    expected = brute_repeats(rows)
    docs = spark.createDataFrame(rows, TEXTS).repartition(3)
    for name, value in (("SEGMENT", 700), ("PART", 2000), ("DEALT", 3000), ("BUCKET", 20), ("HOT", 3), ("BLOCK", 50), ("CHUNK", 256)):
        monkeypatch.setattr(sd, name, value)
    assert repeats(docs) == expected
    monkeypatch.setattr(sd, "HOT", 10**6)
    assert repeats(docs) == expected


def test_equal_hashes_of_unequal_rows_are_told_apart():
    keys = np.array([5, 5, 7, 5], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    assert sd.classes(*keys)[[0, 1, 3]].tolist()[0] == sd.classes(*keys)[3] != sd.classes(*keys)[1]
    assert sd.dense(*keys).tolist() == [0, 1, 2, 0]


def test_cover_ranks_order_texts_as_bytes_do():
    draw = np.random.default_rng(2)
    text = draw.integers(97, 99, 4000).astype("u1")
    text[2000:3000] = text[:1000]
    cover = sd.CoverRanks(text)
    at = np.array([i for i in range(3500) if i % 13 in (0, 1, 3, 9)])
    ranks = cover.of(at)
    strings = [text[i:i + sd.REACH].tobytes() for i in at.tolist()]
    order = sorted(range(len(at)), key=lambda i: strings[i])
    for i, j in zip(order, order[1:]):
        assert (ranks[i] == ranks[j]) == (strings[i] == strings[j]) and ranks[i] <= ranks[j]
    for r1 in range(13):
        for r2 in range(13):
            assert any((r1 + s) % 13 in sd.COVER and (r2 + s) % 13 in sd.COVER for s in range(13))


def test_repeats_of_odd_rows(spark, odd_docs, no_docs):
    long = "".join(chr(97 + (i * i) % 26) for i in range(3000))
    rows = [(1, None), (2, ""), (3, long), (4, long), (4, long), (5, long[:99]), (6, long[7:107]), (None, long[:500])]
    found = sd.drop_repeats(spark.createDataFrame(rows, TEXTS).repartition(4)).collect()
    assert len(found) == len(rows)
    expected = brute_repeats([r for i, r in enumerate(rows) if i != 4])
    for r in found:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == expected[r["doc_id"]]
        assert sum(x["size"] for x in r["removed"]) == r["n_removed"]
    assert sd.drop_repeats(odd_docs).count() == len(ODD_ROWS)
    assert sd.drop_repeats(no_docs).count() == 0
    with pytest.raises(ValueError, match="length must be"):
        sd.drop_repeats(no_docs, length=50)


def test_rows_of_one_id_are_ordered_by_their_text(spark):
    shared = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, shared + " one"), (1, shared + " two"), (1, shared + " two")], TEXTS)
    found = sorted(r["n_removed"] for r in sd.drop_repeats(docs).collect())
    assert found in ([0, 0, len(shared) + 1], [0, len(shared) + 1, len(shared) + 1])

"""Share of planted fuzzy passages that are found, against full alignment."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

from georisk.llm import substring_dedup as sd

VOCABULARY = [f"w{i}" for i in range(5000)]


def edited(draw, words, rate, mixed):
    out = []
    for word in words:
        kind = draw.choice("sid") if mixed and draw.random() < rate else "s" if not mixed and draw.random() < rate else ""
        if kind != "d":
            out.append(draw.choice(VOCABULARY) if kind == "s" else word)
        if kind == "i":
            out.append(draw.choice(VOCABULARY))
    return out


def identity(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1] / max(len(a), len(b))


def planted(draw, sizes, rates, each, holders=2):
    """Texts, and (size, mixed, rate, first id, last id, place, length) of passages that are alike to 0.8 or more."""
    def some(n):
        return [draw.choice(VOCABULARY) for _ in range(n)]

    rows, truth = [], []
    for size in sizes:
        for mixed in (False, True):
            for rate in rates:
                for _ in range(each):
                    first = some(size)
                    copies = [first, *[edited(draw, first, rate, mixed) for _ in range(holders - 1)]]
                    base = len(rows)
                    for copy in copies:
                        before = some(draw.randint(20, 80))
                        rows.append((len(rows), " ".join(before + copy + some(40))))
                    if len(copies[-1]) >= 50 and identity(first, copies[-1]) >= 0.8:
                        truth.append((size, mixed, rate, base, len(rows) - 1, len(before), len(copies[-1])))
    return rows, truth


def shares(found, truth):
    """Of each kind: the share of passages that are found, and the words of these that are covered."""
    spans = defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["start_word"], r["start_word"] + r["n_words"], r["source_doc_id"]))
    hits, covered = defaultdict(list), defaultdict(list)
    for size, mixed, rate, first, last, at, length in truth:
        own = [(a, b) for a, b, source in spans[last] if first <= source < last and a < at + length and b > at]
        hits[size, mixed, rate].append(bool(own))
        if own:
            words = set().union(*[range(max(a, at), min(b, at + length)) for a, b in own])
            covered[size, mixed, rate].append(len(words) / length)
    return {k: np.mean(v) for k, v in hits.items()}, {k: np.mean(v) for k, v in covered.items()}


def test_recall_of_fuzzy_passages(spark):
    rows, truth = planted(random.Random(5), (55, 100), (0.1, 0.15, 0.2), 60)
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hits, covered = shares(found, truth)
    assert len(hits) == 12 and min(hits.values()) >= 0.9, hits
    assert min(covered.values()) >= 0.9, covered
    # Nothing else is alike.
    owner = {i: (first, last) for _, _, _, first, last, _, _ in truth for i in (first, last)}
    strangers = [r for r in found if owner.get(r["doc_id"], (r["source_doc_id"],) * 2)[0] != r["source_doc_id"]]
    assert not strangers


def test_recall_with_holders_between(spark):
    """Four holders, each edited from the first: the last one is linked to one of the earlier ones."""
    rows, truth = planted(random.Random(6), (60, 100), (0.1, 0.2), 30, holders=4)
    hits, _ = shares(sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect(), truth)
    assert min(hits.values()) >= 0.9, hits


def test_frequent_seeds_are_linked_in_parts(spark, monkeypatch):
    """A passage in every document: each copy has a link, and there are a few links for a copy and not one for every other."""
    monkeypatch.setattr(sd, "HOT", 7)
    draw = random.Random(7)
    shared = [draw.choice(VOCABULARY) for _ in range(70)]
    rows = [(i, " ".join([draw.choice(VOCABULARY) for _ in range(30)] + shared + [draw.choice(VOCABULARY) for _ in range(30)]))
            for i in range(60)]
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    links = Counter(r["doc_id"] for r in found)
    assert set(links) == set(range(1, 60)) and sum(links.values()) <= 5 * 60
    assert all(r["n_words"] >= 70 for r in found)


def test_rows_of_one_id_and_rows_without(spark):
    draw = random.Random(8)
    shared = [draw.choice(VOCABULARY) for _ in range(60)]
    texts = [" ".join([f"{c}{i}" for i in range(30)] + shared) for c in "abc"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (None, texts[2]), (2, texts[2])]
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r["doc_id"], r["source_doc_id"], r["start_word"], r["n_words"]) for r in found} == {(2, 1, 30, 60)}
    again = sd.repeated_passages(spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(2)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_partners_beyond_the_nearest_and_the_first_holder(spark):
    """A passage with every eighth word changed, all of whose seeds have holders before its source and after it."""
    draw = random.Random(9)

    def some(n):
        return [draw.choice(VOCABULARY) for _ in range(n)]

    shared = some(72)
    changed = [word + "x" if i % 8 == 7 else word for i, word in enumerate(shared)]
    strangers = [[some(40) + shared[i:i + 7] + some(40) for i in range(0, 72, 8)] for _ in range(2)]
    docs = [*strangers[0], some(40) + shared + some(40), *strangers[1], some(40) + changed + some(40)]
    rows = [(i, " ".join(words)) for i, words in enumerate(docs)]
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert [(r["doc_id"], r["source_doc_id"], r["start_word"], r["source_start"]) for r in found] == [(19, 9, 40, 40)]
    assert 70 <= found[0]["n_words"] <= 72


def test_masked_pairs_agree_with_brute_force(monkeypatch):
    monkeypatch.setattr(sd, "SMALL", 4)
    monkeypatch.setattr(sd, "TILE", 3)
    rng = np.random.default_rng(3)
    seed = np.sort(rng.integers(0, 30, 200))
    ids = rng.integers(0, 9, 200)
    order = np.lexsort((ids, seed))
    seed, ids = seed[order], ids[order]
    asked, held = (np.uint64(1) << rng.integers(0, 4, 200).astype(np.uint64) for _ in range(2))
    asked[::3], held[::5] = 0, 0
    found = [pair for x, y in sd.common_bits(seed, ids, asked, held) for pair in zip(x.tolist(), y.tolist())]
    want = {(i, j) for i in range(200) for j in range(200) if seed[i] == seed[j] and ids[j] < ids[i] and asked[i] & held[j]}
    assert len(found) == len(set(found)) and set(found) == want


def test_runs_of_frequent_words_are_linked_in_proportion(spark, monkeypatch):
    """Runs of one word and of two, each longer than those before: the second round asks one holder and not all."""
    settled = {}
    settle = sd.settle_alone

    def counted(df, name):
        settled[name] = settle(df, name)
        return settled[name]

    monkeypatch.setattr(sd, "settle_alone", counted)
    draw = random.Random(10)
    rows, runs = [], []
    for i in range(40):
        own = [[f"{c}{i}x{k}" for k in range(80)] for c in "abc"]
        words = own[0] + ["the"] * (60 + 4 * i) + own[1] + ["so", "on"] * (30 + draw.randint(0, 60)) + own[2]
        rows.append((i, " ".join(words)))
        runs.append((80, 140 + 4 * i, sum(word in ("so", "on") for word in words)))
    # No earlier run is as long as a passage, but one is alike to 0.8.
    rows += [(40, " ".join(["well"] * 44)), (41, " ".join(["well"] * 53))]
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
    for i, (begin, end, pairs) in enumerate(runs[1:], 1):
        assert set(range(begin, end)) <= covered[i]
        assert len(set(range(end + 80, end + 80 + pairs)) - covered[i]) <= 2
    assert len(covered[41]) >= 52
    assert settled["rest"].where("not spare").count() <= 4 * len(rows)


def test_common_neighbours_agree_with_brute_force(monkeypatch):
    monkeypatch.setattr(sd, "SMALL", 4)
    monkeypatch.setattr(sd, "TILE", 3)
    monkeypatch.setattr(sd, "HANDED", 50)
    rng = np.random.default_rng(4)
    seeds, ids = np.sort(rng.integers(0, 6, 120)), rng.integers(0, 15, 120)
    text = rng.integers(0, 3, 120)
    order = np.lexsort((ids, text, seeds))
    seeds, ids, text = seeds[order], ids[order], text[order]
    new = np.append(True, (np.diff(seeds) != 0) | (np.diff(text) != 0))
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    holder = np.sort(np.append(np.arange(120), rng.integers(0, 120, 240)))
    codes = rng.integers(0, 40, 360).astype(np.uint32)
    found = {pair for x, y in sd.common_neighbours(seeds, ids, holder, first, codes) for pair in zip(x.tolist(), y.tolist())}
    asked, held = defaultdict(set), defaultdict(set)
    for row, code in zip(holder.tolist(), codes.tolist()):
        held[first[row]].add(code >> 1)
        if code & 1 and ids[row] == ids[first[row]]:
            asked[row].add(code >> 1)
    assert found == {(i, j) for i in asked for j in held if seeds[i] == seeds[j] and ids[j] < ids[i] and asked[i] & held[j]}


def test_links_of_many_pairs_are_joined_at_once(monkeypatch):
    calls = []
    join = sd.equal_runs
    monkeypatch.setattr(sd, "equal_runs", lambda *given: (calls.append(1), join(*given))[1])
    places = np.arange(0, 60, 3)
    links = np.concatenate([
        np.stack([np.full(20, v) for v in (i + 1, 0, i + 1, 0, 0, 0)] + [places + 10, places + i, np.full(20, sd.SEED_WORDS)])
        for i in range(300)], axis=1)
    table = sd.pa.Table.from_batches([sd.packed_rows(sd.LINK, np.zeros(links.shape[1], np.int64), links)])
    found = sd.chain_part(table).to_pylist()
    assert sorted((r["id"], r["x"], r["x_end"], r["y"], r["y_end"], r["spare"]) for r in found) == [
        (i + 1, 10, 71, i, i + 61, False) for i in range(300)]
    assert len(calls) == 1
    # Blocks of a few links give the same.
    monkeypatch.setattr(sd, "CHAINED", 30)
    assert sorted(map(str, sd.chain_part(table).to_pylist())) == sorted(map(str, found))


def test_blocks_of_pairs_agree_with_each_pair_alone():
    rng = np.random.default_rng(11)
    spans = [tuple(rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint32) for _ in "ab") for _ in range(60)]
    pairs = sd.Pairs(*[[span[k].tobytes() for span in spans] for k in (0, 1)])
    good = pairs.can_match(12, 0.8)
    ends = rng.integers(-5, 5, (60, 2))
    pair, x, y = pairs.matches(np.ones(60, bool), ends)
    assert good.any() and not good.all()
    for i, (a, b) in enumerate(spans):
        def stretch(one, other, size):
            held = np.isin(one, other)
            return any(held[j:k].mean() >= 0.8 - 1e-9 for j in range(len(one)) for k in range(j + size, len(one) + 1))
        assert good[i] == (stretch(a, b, 12) and stretch(b, a, 10))
        want = set()
        for p in range(len(a) - 3):
            line = np.rint(p + ends[i, 0] + (ends[i, 1] - ends[i, 0]) * p / len(a))
            held = [q for q in range(len(b) - 3) if (a[p:p + 4] == b[q:q + 4]).all()]
            want |= {(p, max(q for q in held if q < line))} if any(q < line for q in held) else set()
            want |= {(p, min(q for q in held if q >= line))} if any(q >= line for q in held) else set()
        assert set(zip(x[pair == i].tolist(), y[pair == i].tolist())) == want


def test_gapped_extension_agrees_with_a_table():
    rng = np.random.default_rng(12)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(0, sd.MARGIN + 1)).tolist() for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if p == q else max(table[i, j + 1], table[i + 1, j])
        score = 4 * table - np.arange(len(a) + 1)[:, None] - np.arange(len(b) + 1)
        i, j = np.unravel_index(score.argmax(), score.shape)
        assert sd.gapped_extension(a, b) == (i, j, table[i, j])


def test_links_take_little_room_and_come_back_whole():
    rng = np.random.default_rng(21)
    pairs = rng.integers(0, 1 << 40, (500, 6))
    which = rng.permutation(np.repeat(np.arange(500), 40))
    x = rng.integers(0, 400, len(which))
    links = np.concatenate([pairs[which].T, [x, x + which % 50, np.full(len(which), sd.SEED_WORDS)]])
    out = sd.packed_links(links, 7)
    back = sd.unpacked_rows(sd.pa.Table.from_batches([out]), sd.LINK_FIELDS)
    assert sorted(map(tuple, back.T.tolist())) == sorted(map(tuple, links.T.tolist()))
    assert sorted(out.column("part").to_pylist()) == sorted(set(sd.dealt(7, links[1], links[2], links[6] >> sd.STRETCH).tolist()))
    plain = len(sd.packed(np.ascontiguousarray(links).tobytes()))
    assert sum(len(x) for x in out.column("body").to_pylist()) < plain / 2


def test_links_are_deleted_when_they_are_chained(spark, monkeypatch):
    draw = random.Random(5)
    rows, _ = planted(draw, (60,), (0.0,), 3)
    settled = {}
    settle = sd.settle
    monkeypatch.setattr(sd, "settle", lambda df, name: settled.setdefault(name, settle(df, name)))
    found = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.count() >= 3
    kept = {name for name, table in settled.items() if all(Path(file.removeprefix("file:")).exists() for file in table.inputFiles())}
    assert kept == {"chains", "passages", "rest"} and {"links", "shared_keys"} <= set(settled)

"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import io
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from georisk.llm import arrays, embedding_pairs, graph, line_crf, line_dedup, mixing, ngram_join
from georisk.llm import packing, quality_rules, substring_dedup, toxicity, warc_zip
from tests.llm.conftest import ODD_ROWS


def test_words_and_hashes_do_not_cross_rows():
    column = pa.array(["ab", "cd ef", None, "", " \n", "é  ab"])
    buf, offsets = next((b, o) for _, _, b, o in arrays.slices(column))
    starts, ends, bounds = arrays.words(buf, offsets)
    assert [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)] == ["ab", "cd", "ef", "é", "ab"]
    assert bounds.tolist() == [0, 1, 3, 3, 3, 3, 5]
    hashes = arrays.span_hashes(buf, starts, ends)
    assert hashes[0] == hashes[4] and len(set(hashes.tolist())) == 4
    values, at = arrays.shingles(hashes, bounds, 5)
    assert np.diff(at).tolist() == [1, 1, 0, 0, 0, 1]


def test_line_spans_keep_empty_lines():
    buf, offsets = next((b, o) for _, _, b, o in arrays.slices(pa.array(["a\n\nb", "", "\n", "c"])))
    starts, ends, bounds = line_crf.line_spans(buf, offsets)
    assert np.diff(bounds).tolist() == [3, 1, 2, 1]
    assert [bytes(buf[a:b]) for a, b in zip(starts, ends)] == [b"a", b"", b"b", b"", b"", b"", b"c"]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (9, 8), (8, 9)], "a long, b long")
    found = {r["id"]: r["component"] for r in graph.components(edges, "a", "b").collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 8: 8, 9: 8}
    assert graph.components(edges.limit(0), "a", "b").count() == 0


def test_line_dedup_cases(spark, odd_docs, no_docs):
    rows = line_dedup.dedup_lines(odd_docs.select("doc_id", "text", "n_lines")).collect()
    assert len(rows) == len(ODD_ROWS)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["text"] == "other" and by_id[None]["n_dropped"] == 1
    assert by_id[6]["text"] == "" and by_id[6]["n_dropped"] == 2 and by_id[7]["n_dropped"] == 0
    assert by_id[1]["text"] == "" and by_id[1]["n_lines"] == 1 and by_id[10]["n_lines"] == 501
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_heavy_lines_are_dropped_as_well(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY_LINES", 5)
    monkeypatch.setattr(line_dedup, "HEAVY_SHARE", 4)
    docs = spark.createDataFrame(
        [(i, f"this is the one line of every page\nunique line number {i} stays here") for i in range(40)], "doc_id long, text string")
    rows = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(docs).collect()}
    assert rows == {i: int(i != 39) for i in range(40)}


def test_perfect_hash_is_minimal_and_survives_equal_keys():
    keys = arrays.mix(np.arange(5000, dtype=np.uint64))
    assert sorted(line_dedup.PerfectHash.build(keys).places(keys).tolist()) == list(range(5000))
    twice = np.array([3, 3, 9], np.uint64)
    assert line_dedup.PerfectHash.build(twice).places(twice).max() <= 2


def test_ngram_join_cases(spark, odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in ngram_join.jaccard_links(odd_docs).collect()}
    assert set(rows) == {r[0] for r in ODD_ROWS}
    assert rows[4]["n_links"] == rows[5]["n_links"] == 1 and rows[5]["component_id"] == 4
    for blank in (1, 2, 3, 10):
        assert rows[blank]["n_links"] == 0 and rows[blank]["kept"] and rows[blank]["class_id"] is None
    assert ngram_join.jaccard_links(no_docs).count() == 0
    # Of "one two" the first stays; the row without an id is a near copy of document 7.
    kept = ngram_join.keep_one_per_group(odd_docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert ngram_join.keep_one_per_group(odd_docs).columns == odd_docs.columns


LONG_A = " ".join(f"w{i}" for i in range(300))
LONG_B = LONG_A.replace("w299", "other")


def test_rows_of_one_id_and_rows_without_are_told_apart(spark):
    clean = " ".join(f"c{i}" for i in range(60))
    rows = [(5, LONG_A), (5, LONG_B), (7, LONG_A), (9, clean), (9, LONG_B), (None, clean), (None, clean + " more"), (None, "own words of no one else")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    links = {(r["doc_id"], r["class_id"], r["n_links"], r["component_id"]) for r in ngram_join.jaccard_links(docs).collect()}
    assert (5, 5, 3, 5) in links and (7, 5, 3, 5) in links and (9, 5, 3, 5) in links and (9, 9, 2, 9) in links
    assert (None, None, 2, 9) in links and (None, None, 0, None) in links
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in ngram_join.keep_one_per_group(docs).collect())
    assert [k for k, _ in kept] == [0, 5, 9] and kept[0][1] == "own words of no one else" and kept[2][1] == clean
    # Copies without an id: one of them stays.
    docs = spark.createDataFrame([(None, clean), (None, clean), (7, clean), (None, LONG_A), (None, LONG_A)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in ngram_join.keep_one_per_group(docs).collect()) == [(0, LONG_A), (7, clean)]


def test_vectors_of_one_id_are_told_apart(spark):
    rows = [(5, "a", [1.0, 0.0]), (5, "a", [1.0, 0.1]), (8, "a", [0.0, 1.0]), (5, "a", [0.0, 1.0]), (9, "b", [1.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    found = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_pairs.cosine_links(docs).collect())
    assert found == [(5, 1, 5, True), (5, 1, 5, True), (5, 1, 5, True), (8, 1, 5, False), (9, 0, 9, True)]


def test_shards_vary_as_multinomial_draws_and_totals_hold():
    totals = mixing.whole_slots(np.array([0.05, 0.2, 0.75]), 4096 * 256)
    assert totals.sum() == 4096 * 256 and abs(totals[0] - 0.05 * 4096 * 256) <= 1
    counts = np.array([mixing.shard_counts(totals, 4096, 256, shard, 7) for shard in range(256)])
    assert (counts.sum(1) == 4096).all() and (counts.sum(0) == totals).all()
    for own, share in zip(counts.T, (0.05, 0.2, 0.75)):
        assert 0.7 < own.var() / (4096 * share * (1 - share)) < 1.35
    assert not np.array_equal(counts[0], mixing.shard_counts(totals, 4096, 256, 0, 8))
    # The last shard is shorter, and numbers beyond the exact draw keep their mean and variance.
    short = np.array([7, 0, 13])
    parts = [mixing.shard_counts(short, 8, 3, shard, 1) for shard in range(3)]
    assert [p.sum() for p in parts] == [8, 8, 4] and np.array_equal(sum(parts), short)
    draw = np.random.default_rng(3)
    large = np.array([mixing.draw_part(np.array([10**9, 3 * 10**9]), 10**6, draw)[0] for _ in range(400)])
    assert abs(large.mean() - 250_000) < 100 and 0.8 < large.var() / 187_500 < 1.25


def near_copies(n):
    words = [f"w{i}" for i in range(120)]
    return [(i, " ".join([*words[:i % 100], f"edit{i}", *words[i % 100 + 1:]])) for i in range(n)]


def test_ngram_join_tiles_agree_with_one_group(spark, monkeypatch):
    docs = spark.createDataFrame(near_copies(90), "doc_id long, text string")
    whole = sorted(map(tuple, ngram_join.jaccard_links(docs).collect()))
    monkeypatch.setattr(ngram_join, "TILE", 8)
    assert sorted(map(tuple, ngram_join.jaccard_links(docs).collect())) == whole
    assert sum(r[2] for r in whole) > 90


def test_pruning_keeps_pairs_at_the_threshold():
    limits = ngram_join.least_matches(0.8, ngram_join.TOLERANCE)
    rng = np.random.default_rng(1)
    for _ in range(200):
        same = rng.random(ngram_join.VALUES) < 0.8
        sig = np.stack([np.zeros(ngram_join.VALUES, np.uint8), np.where(same, 0, 1).astype(np.uint8)])
        assert len(ngram_join.survivors(sig, 0, np.array([1]), limits)) == 1


def test_packing_cases(spark, odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in ODD_ROWS}
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    long = sorted((r for r in rows if r["doc_id"] == 8), key=lambda r: r["piece"])
    assert len(long) > 5 and all(r["length"] == 1024 for r in long[1:])
    empty = packing.pack_documents(no_docs)
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_packing_rounds_use_no_bin_twice(spark):
    rng = np.random.default_rng(3)
    pieces = spark.createDataFrame(
        [(i, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 1025, 3000))],
        "doc_id long, piece int, length long, ids_crc32 long")
    rows = packing.pack(pieces, group_items=400).toPandas()
    assert len(rows) == 3000 and rows.groupby("sequence_id").length.sum().max() <= 1024
    alone = len(packing.best_fit(rows.length.to_numpy(), 1024)[1])
    assert rows.sequence_id.nunique() <= alone * 1.02


@pytest.mark.parametrize("lengths", [[], [1024] * 5, [600] * 7, [513, 512, 511], [400] * 9, [1] * 3000])
def test_bounds_never_exceed_the_packing(lengths):
    lengths = np.array(lengths, np.int64)
    assert packing.lower_bound(lengths, 1024) <= len(packing.best_fit(lengths, 1024)[1])
    assert packing.lower_bound(np.array([600] * 7), 1024) == 7


def test_mixing_cases(spark, odd_docs, no_docs):
    rows = mixing.mix_plan(odd_docs).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix_plan(no_docs).count() == 0
    assert mixing.mix_plan(odd_docs.where("doc_id in (1, 2, 3)")).agg(F.sum("taken")).first()[0] == 0
    mixed = mixing.mix_texts(odd_docs)
    assert mixed.columns == odd_docs.columns
    by_id = {r["doc_id"]: r["taken"] for r in rows}
    for r in mixed.where("doc_id is not null and doc_id <> 5").collect():
        assert len(arrays.words(*next((b, o) for _, _, b, o in arrays.slices(pa.array([r["text"]]))))[0]) == by_id[r["doc_id"]]


def test_permutations_are_permutations():
    for size in (1, 2, 3, 64, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 5).tolist()) == list(range(size))


def test_quality_rule_cases(spark, odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in quality_rules.rate_texts(odd_docs).collect()}
    assert rows[1]["n_words"] == 0 and rows[1]["base_failed"] and not rows[1]["kept"]
    assert rows[8]["n_words"] == rows[8]["n_repeat_words"] == 30_000
    assert quality_rules.rate_texts(no_docs).count() == 0


def test_cascade_order_never_changes_the_verdict():
    column = pa.array([t for _, t, *_ in ODD_ROWS] + ["THE CAT!! " * 30, "a | b | c " * 40, "plain words of a text " * 9])
    buf, offsets = next((b, o) for _, _, b, o in arrays.slices(column))
    names = list(quality_rules.RULES)
    want = quality_rules.passes(quality_rules.Texts(buf, offsets), names, quality_rules.RULES).tolist()
    assert quality_rules.passes(quality_rules.Texts(buf, offsets), names[::-1], quality_rules.RULES).tolist() == want


def test_classifier_cases(spark, odd_docs, no_docs, labels):
    rows = line_crf.score_quality(odd_docs, labels).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert line_crf.score_quality(no_docs, labels).count() == 0
    none = line_crf.score_quality(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert line_crf.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_crf_gradient_and_marginals():
    rng = np.random.default_rng(0)
    logit, tie = rng.normal(size=5), rng.normal(size=(2, 2))
    bounds = np.array([0, 2, 5])
    _, _, odds, whole = line_crf.Chains(bounds).run(logit, tie)
    sums, marginal = 0.0, np.zeros(5)
    for a, b in ((0, 2), (2, 5)):
        paths = [[(k >> i) & 1 for i in range(b - a)] for k in range(1 << (b - a))]
        score = np.array([sum(logit[a + i] * y for i, y in enumerate(p)) + sum(tie[p[i], p[i + 1]] for i in range(len(p) - 1)) for p in paths])
        sums += np.log(np.exp(score).sum())
        marginal[a:b] = (np.exp(score)[:, None] * np.array(paths)).sum(0) / np.exp(score).sum()
    assert whole == pytest.approx(sums)
    assert 1 / (1 + np.exp(-odds)) == pytest.approx(marginal)


def test_toxicity_cases(spark, odd_docs, no_docs, documents, labels):
    rows = toxicity.score_toxicity(odd_docs, labels).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(no_docs, labels).count() == 0


def test_disguised_words_are_read():
    words = {"idiot": 400, "stupid": 300, "pathetic": 300, "clown": 200, "scum": 200, "the": 9000, "an": 8000, "thing": 900, "loser": 300}
    grams: dict[str, int] = {}
    for word, n in words.items():
        line = "^^" + word + "^"
        for i in range(len(line) - 2):
            grams[line[i:i + 3]] = grams.get(line[i:i + 3], 0) + n
    reader = toxicity.Reader({g: 2.0 for g in grams})
    for text, want in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"),
                       ("$tup1d", "stupid"), ("p@th3t1c!", "pathetic!"), ("cl0wn", "clown"), ("the thing", "the thing")):
        assert reader.restore(text) == want


def test_substring_cases(spark, odd_docs, no_docs):
    assert substring_dedup.repeated_passages(no_docs).count() == 0
    rows = substring_dedup.repeated_passages(odd_docs).collect()
    assert {r["doc_id"] for r in rows} <= {5, 8, 9}
    words = [f"w{i}" for i in range(400)]
    passage = words[100:180]
    edited = [*passage[:30], "new", *passage[31:60], "more", *passage[60:]]
    docs = spark.createDataFrame([
        (1, " ".join(words)), (2, " ".join(["x%d" % i for i in range(90)] + edited + ["y%d" % i for i in range(50)])),
        (3, " ".join("z%d" % i for i in range(300)))], "doc_id long, text string")
    found = substring_dedup.repeated_passages(docs).collect()
    assert [(r["doc_id"], r["source_doc_id"]) for r in found] == [(2, 1)]
    assert found[0]["start_word"] == 90 and found[0]["n_words"] == 81 and found[0]["source_start"] == 100
    assert found[0]["matched"] == 79


def test_scoring_reads_all_disguises_that_fitting_reads():
    costs = {}
    for word in ("idiot", "dumb", "scum"):
        line = "^^" + word + "^"
        costs |= {line[i:i + 3]: 2.0 for i in range(len(line) - 2)}
    reader = toxicity.Reader(costs)
    scale = toxicity.Scale({"=" + w: (50, 500, 0) for w in ("idiot", "dumb", "scum")}, (1000, 1000))
    for text in ("an i. d. i. o. t here", "an i- d- i- o- t here", "an i* d* i* o* t here", "so \"d u m b\" it is",
                 "all (s c u m) here", "an i/d/i/o/t here", "an I, D, I, O, T here", "an 1d10t here", "an i d i o t here"):
        restored = reader.restore(text)
        assert any(w in toxicity.WORD.findall(restored) for w in ("idiot", "dumb", "scum")), text
        found = scale.telling(text, reader)
        assert found == scale.telling(restored, reader) and len(found[0]) == 1, text


def all_readings(reader, span):
    """Every reading of a span and its cost, without any pruning."""
    found = [((toxicity.EDGE, toxicity.EDGE), 0.0, "")]
    for place, char in enumerate(span):
        following = []
        letters = toxicity.STANDS_FOR.get(char, "")
        for (a, b), price, text in found:
            if char in toxicity.SEPARATORS:
                end = 0.0 if b == toxicity.EDGE else reader.cost(a, b, toxicity.EDGE)
                following += [((a, b), price + toxicity.DROP_SEPARATOR, text),
                              ((toxicity.EDGE, toxicity.EDGE), price + end, text + " ")]
                continue
            if place and span[place - 1] == char and (b == toxicity.char_of(char) or b in letters):
                following.append(((a, b), price + toxicity.DROP_REPEAT, text))
            options = [(char, 0.0)] if char.isalpha() else []
            options += [(letter, toxicity.SUBSTITUTE) for letter in letters]
            for letter, extra in options or [(char, toxicity.UNSEEN)]:
                shown = toxicity.char_of(letter)
                following.append(((b, shown), price + extra + reader.cost(a, b, shown), text + letter))
        found = following
    ends = [(price + (0.0 if b == toxicity.EDGE else reader.cost(a, b, toxicity.EDGE)), text) for (a, b), price, text in found]
    return min(price for price, _ in ends), ends


@pytest.mark.parametrize("span", ["1d10t", "i d i", "1.6.8", "aa@@", "b 0 0 b", "666", "x_y"])
def test_the_decoder_finds_the_cheapest_of_all_readings(span):
    draw = np.random.default_rng(len(span))
    letters = "idotagbszly^"
    costs = {a + b + c: float(draw.uniform(0.2, 6)) for a in letters for b in letters for c in letters}
    reader = toxicity.Reader(costs)
    least, ends = all_readings(reader, span)
    assert reader.decode(span) in {text for price, text in ends if price <= least + 1e-9}


def test_scores_of_a_column_equal_those_of_whole_restored_texts():
    costs = {"^^i": 1.0, "^id": 1.0, "idi": 1.0, "dio": 1.0, "iot": 1.0, "ot^": 1.0}
    entries = {"=idiot": (50, 500, 0), "=scum": (40, 300, 1)}
    model = toxicity.Model(costs, entries, (1000, 1000), np.linspace(-1, 1, 8))
    texts = ["", None, "an 1d10t, (scum) and \"idiot\"!", "i d i o t here", "a b c d e", "idiooot scum scum", "Ünï - ø 1.2.3 i.d.i.o.t",
             "word\u00a0idiot \u2003scum", "x" * 200 + " idiot", "i- d- i- o- t", "'i d i o t'", "so i_d_i_o_t it is", "日 本 語 x"] * 3
    reader, scale = toxicity.Reader(costs), toxicity.Scale(entries, (1000, 1000))
    for text, score in zip(texts, model.scorer()(pa.array(texts))):
        x = toxicity.evidence(*scale.telling((text or "").lower(), reader))
        assert score == pytest.approx(1 / (1 + np.exp(-float(np.dot(model.theta, x)))))


def test_rows_that_apart_finds_are_never_missed():
    draw = np.random.default_rng(6)
    signs = ["a", "b", "é", " ", ".", "-", "\n", "1", "$", "_", "日", ",", "  ", "word"]
    texts = ["".join(draw.choice(signs, 14)) for _ in range(3000)]
    for first, last, buf, offsets in arrays.slices(pa.array(texts)):
        named = toxicity.may_be_apart(buf, offsets)
        for row, text in enumerate(texts[first:last]):
            assert named[row] or not toxicity.APART.search(text), text


def passages_of(spark, *texts):
    docs = spark.createDataFrame([(i + 1, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = substring_dedup.repeated_passages(docs).collect()
    return sorted((r["doc_id"], r["source_doc_id"], r["start_word"], r["n_words"], r["source_start"]) for r in rows)


def test_passages_with_unrelated_text_between_them(spark):
    head, foot = [f"h{i}" for i in range(100)], [f"f{i}" for i in range(100)]
    one, two = ([f"{c}{i}" for i in range(120)] for c in "xy")
    assert passages_of(spark, head + one + foot, head + two + foot) == [(2, 1, 0, 100, 0), (2, 1, 220, 100, 220)]


def test_exact_passage_whose_stretches_earlier_documents_hold(spark):
    shared = [f"p{i}" for i in range(60)]
    parts = [shared[i:i + 20] + [f"a{i}_{j}" for j in range(40)] for i in range(0, 60, 4)]
    own = [[f"{c}{i}" for i in range(40)] for c in "bc"]
    n = len(parts)
    found = passages_of(spark, *parts, own[0] + shared + own[0][::-1], own[1] + shared + own[1][::-1])
    assert (n + 2, n + 1, 40, 60, 40) in found


@pytest.mark.parametrize("every", [5, 6, 8])
def test_passage_with_regular_changes(spark, every):
    shared = [f"p{i}" for i in range(120)]
    changed = [f"e{i}" if i % every == every - 1 else w for i, w in enumerate(shared)]
    own = [[f"{c}{i}" for i in range(40)] for c in "bc"]
    found = passages_of(spark, own[0] + shared + own[0][::-1], own[1] + changed + own[1][::-1])
    assert [(d, s) for d, s, *_ in found] == [(2, 1)] and found[0][3] >= 115


def test_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = (rng.integers(0, 4, rng.integers(0, 12)).astype(np.uint32) for _ in "ab")
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert substring_dedup.common_length(a, b) == table[-1, -1]


def test_embedding_cases(spark):
    x, y = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0]
    rows = [(1, x, 1), (2, y, 1), (3, x, 2), (4, x, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, x, 1), (10, x, 1), (None, x, 1), (11, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit(9))
    found = {r["vec_id"]: r for r in embedding_pairs.cosine_links(table).collect()}
    assert {i: r["n_links"] for i, r in found.items()} == {
        1: 2, 2: 2, 10: 2, **{i: 0 for i in (3, 4, 5, 6, 7, 8, 9, 11, None)}}
    assert found[10]["component_id"] == found[2]["component_id"] == 1
    assert embedding_pairs.cosine_links(table.limit(0)).count() == 0


def test_embedding_tiles_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_pairs, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    data = centres[rng.integers(0, 12, 200)] + rng.normal(size=(200, 8)) * 0.25
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(data)], "vec_id long, embedding array<double>, label int")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & ~np.eye(200, dtype=bool)
    found = {r["vec_id"]: r["n_links"] for r in embedding_pairs.cosine_links(table).collect()}
    assert found == {i: int(near[i].sum()) for i in range(200)} and near.any()


def test_archive_cases(spark):
    big = "x" * 200
    rows = [(1, "http://a/?q=%41\r\nb", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", "short"), (4, "u", "short"),
            (5, "é", None), (6, "u", "é" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    found = warc_zip.archive_round_trip(pages).collect()
    assert len(found) == len(rows)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in found)
    assert kinds == sorted([(0, "revisit", 1), (1, "response", None), (2, "revisit", 1), (2, "revisit", 1), (3, "response", None),
                            (4, "response", None), (5, "response", None), (6, "response", None)], key=lambda x: (x[0], x[1]))
    assert {r["page_id"]: r["url"] for r in found}[1] == rows[0][1]
    assert {r["page_id"]: r["payload_bytes"] for r in found}[6] == 10000
    assert warc_zip.archive_round_trip(pages.limit(0)).count() == 0


def test_zip64_directories_are_read(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_STORED) as out:
        out.comment = b"a comment"
        out.writestr("first", b"1" * 50)
        out.writestr("second", b"2" * 70)
        out.writestr(zipfile.ZipInfo("packed"), b"3" * 90, zipfile.ZIP_DEFLATED)
    raw = body.getvalue()
    assert warc_zip.END64 in raw
    file = pa.BufferReader(raw)
    members = warc_zip.read_members(file)
    assert [(m.name, m.size) for m in members] == [("first", 50), ("second", 70), ("packed", 90)]
    start, size = warc_zip.stored_place(file, members, "second")
    assert raw[start:start + size] == b"2" * 70
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.stored_place(file, members, "packed")
    with pytest.raises(ValueError, match="no member"):
        warc_zip.stored_place(file, members, "third")
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.read_members(pa.BufferReader(struct.pack("<I", 1) * 20))

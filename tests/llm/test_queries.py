"""Registered queries against their SQL or a brute-force version, on whole small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import pytest

from tests.oracle_check import compare, connect
from georisk.llm.oracles import ORACLES
from georisk.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) is None


def shingles(text):
    words = WORD.findall(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_links(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            holders[shingle].append(i)
    pairs = set()
    for i, s in sets.items():
        for j, n in Counter(j for shingle in s for j in holders[shingle] if j > i).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                pairs.add((i, j))
    return pairs


def least_reachable(ids, pairs):
    best = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(best[a], best[b])
            if best[a] != low or best[b] != low:
                best[a] = best[b] = low
                changed = True
    return best


def test_ngram_join_equals_brute_force(spark, sf_dir, texts):
    pairs = brute_links(texts)
    linked = Counter(x for pair in pairs for x in pair)
    best = least_reachable(texts, pairs)
    rows = QUERIES["op10_ngram_jaccard_join"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["n_links"] == linked[row["doc_id"]]
        assert row["component_id"] == best[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == best[row["doc_id"]])


def test_packing_holds_the_tokenizers_own_ids(spark, sf_dir, texts):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op3_best_fit_packing"](spark, sf_dir).collect()
    pieces, sequences = defaultdict(dict), defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]][row["piece"]] = row
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert set(pieces) == set(texts)
    total = 0
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        own = [pieces[doc_id][i] for i in range(len(pieces[doc_id]))]
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 1024 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        total += len(ids)
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 1024
        assert all(a + n == b for (a, n), (b, _) in pairwise(parts))
    assert len(sequences) <= -(-total // 1024) * 1.01 + 2


def test_mix_comes_near_its_targets(spark, sf_dir, texts):
    from georisk.llm.mixing import targets

    rows = QUERIES["op1_mix_sources"](spark, sf_dir).collect()
    again = QUERIES["op1_mix_sources"](spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len(WORD.findall(t)) for i, t in texts.items()}
    size, taken, goal = Counter(), Counter(), {}
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        size[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
        goal[source[r["doc_id"]]] = r["target"]
    names = sorted(size)
    want = targets([size[n] for n in names], [1 + i % 3 for i in range(len(names))])
    for name, value in zip(names, want):
        assert goal[name] == pytest.approx(value)
        assert abs(taken[name] - value) <= 0.1 * value + 2 * 64


def test_targets_share_what_is_above_the_cap():
    from georisk.llm.mixing import targets

    assert targets([100, 10], [1, 9]) == [80.0, 30.0]
    assert targets([10, 0], [1, 1]) == [10.0, 0.0]
    assert targets([], []) == []


def held_out_quality(spark, sf_dir, name, label):
    rows = QUERIES[name](spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    caught = [r["predicted"] for r in rows if r[label] == 1]
    wrong = [r["predicted"] for r in rows if r[label] == 0]
    return caught, wrong


def test_quality_on_held_out_documents(spark):
    caught, wrong = held_out_quality(spark, "/root/testdata/sf0.01", "op9_quality_classifier", "quality")
    assert sum(caught) >= 0.98 * len(caught)
    assert sum(wrong) <= 0.2 * len(wrong)


def test_toxicity_on_held_out_documents(spark):
    caught, wrong = held_out_quality(spark, "/root/testdata/sf0.01", "op4_toxicity", "toxic")
    assert sum(caught) >= 0.7 * len(caught)
    assert sum(wrong) <= 0.02 * len(wrong)


def test_every_exact_passage_of_50_words_is_covered(spark, sf_dir, texts):
    """Word by word: all that lies in 50 words which an earlier document holds as well."""
    seen, need = set(), defaultdict(set)
    for i, text in sorted(texts.items()):
        words, own = WORD.findall(text), set()
        for j in range(len(words) - 49):
            window = tuple(words[j:j + 50])
            if window in seen:
                need[i].update(range(j, j + 50))
            own.add(window)
        seen |= own
    rows = QUERIES["op2_substring_dedup"](spark, sf_dir).collect()
    have = defaultdict(set)
    for r in rows:
        have[r["doc_id"]].update(range(r["start_word"], r["start_word"] + r["n_words"]))
    assert need and all(words <= have[i] for i, words in need.items())
    for r in rows:
        assert r["source_doc_id"] < r["doc_id"] and r["n_words"] >= 50 and r["identity"] >= 0.8
        a = WORD.findall(texts[r["doc_id"]])[r["start_word"]:][:r["n_words"]]
        b = WORD.findall(texts[r["source_doc_id"]])[r["source_start"]:][:r["source_words"]]
        assert len(a) == r["n_words"] and len(b) == r["source_words"]
        assert sum((Counter(a) & Counter(b)).values()) >= r["matched"]


def test_pipeline_equals_its_stages(spark, sf_dir, documents):
    import corpus_pipeline as p

    docs, ids = documents, None
    for name, stage in p.STAGES:
        docs = p.settle(stage(spark, docs, sf_dir), name)
        if name != "best_fit_packing":
            assert docs.columns == documents.columns
            now = {r["doc_id"] for r in docs.select("doc_id").collect()}
            assert now and (ids is None or now <= ids)
            ids = now
            if name == "ngram_jaccard_join":
                texts = {r["doc_id"]: r["text"] for r in docs.collect()}
                assert not brute_links(texts)
    assert {r["doc_id"] for r in docs.collect()} == ids
    run = sorted(tuple(r) for r in p.run(spark, sf_dir).drop("sequence_id", "offset", "gap").collect())
    assert run == sorted(tuple(r) for r in docs.drop("sequence_id", "offset", "gap").collect())

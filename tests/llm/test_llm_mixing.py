from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_tables import DOCUMENTS, documents, sentence

from coverbay.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mixture(seed=1):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, words=rng.randrange(0, 80)), "en", s, 1) for i, s in enumerate("a" * 300 + "b" * 100 + "c" * 10 + "d" * 40 + "é" * 5)]
    return rows + [(500 + i, "lone words", "en", None, 1) for i in range(20)]


def test_targets_reshare_what_is_above_three_times():
    assert mixing.targets([100, 100, 100]) == pytest.approx([187.5, 75, 37.5])
    got = mixing.targets([10, 1000, 10])
    assert got[0] == 30 and got[2] == 30 and got[1] == pytest.approx(960)
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    for sizes in ([5, 1, 900, 3, 77], [1, 1, 1, 100], [0, 10]):
        got = mixing.targets(sizes)
        assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))


def test_split_is_exact_and_near_the_shares():
    quotas = np.array([1000, 0, 37, 5000], np.int64)
    parts = mixing.split(quotas, 7, np.random.default_rng(1))
    assert (parts.sum(1) == quotas).all() and (parts >= 0).all()
    assert parts.sum(0).max() - parts.sum(0).min() <= 3
    assert (abs(parts[3] - 5000 / 7) < 120).all()


def test_planned_meets_targets_and_repeats(spark):
    rows = mixture()
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(6)
    got = mixing.planned(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    source, text = {r[0]: r[3] for r in rows}, {r[0]: r[1] for r in rows}
    order = sorted({s for s in source.values() if s}) + [None]
    sizes = {s: sum(words(text[i]) for i in source if source[i] == s) for s in order}
    targets = dict(zip(order, mixing.targets([sizes[s] for s in order])))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == words(text[r["doc_id"]]) and r["source_size"] == sizes[s] and r["target"] == pytest.approx(targets[s])
        assert 0 <= r["copies"] <= 3 and len(r["shards"]) == r["copies"] and all(0 <= x < 8 for x in r["shards"])
        taken[s] += r["size"] * r["copies"]
        largest[s] = max(largest[s], r["size"])
    for s in order:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1
    again = mixing.planned(docs.repartition(3)).collect()
    assert sorted(map(str, ((r["doc_id"], r["copies"], r["shards"]) for r in again))) == sorted(map(str, ((r["doc_id"], r["copies"], r["shards"]) for r in got)))


def test_drawn_rows_are_the_copies_and_positions_gapless(spark):
    docs = spark.createDataFrame(mixture(2), DOCUMENTS)
    copies = {r["doc_id"]: r["copies"] for r in mixing.planned(docs).collect()}
    rows = mixing.drawn(docs).collect()
    counted, places = defaultdict(int), defaultdict(list)
    for r in rows:
        counted[r["doc_id"]] += 1
        places[r["shard"]].append(r["position"])
    assert counted == {k: v for k, v in copies.items() if v}
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert len(places) == 8


def test_dealt_rows_carry_the_drawn_copies(spark):
    rows = mixture(4) + documents(random.Random(4), 0)
    docs = spark.createDataFrame([(*r, 9) for r in rows], DOCUMENTS + ", copies int").repartition(4)
    plan = sorted((str(r["doc_id"]), r["size"], r["target"], r["shards"]) for r in mixing.planned(docs).collect())
    got = mixing.dealt(docs).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["target"], [c["shard"] for c in r["copies"]]) for r in got) == plan
    assert all([c["copy"] for c in r["copies"]] == list(range(len(r["copies"]))) for r in got)
    listed = sorted((str(r["doc_id"]), c["shard"], c["position"]) for r in got for c in r["copies"])
    assert listed == sorted((str(r["doc_id"]), r["shard"], r["position"]) for r in mixing.drawn(docs).collect())
    places = defaultdict(list)
    for _, shard, position in listed:
        places[shard].append(position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_mixed_documents_equal_the_plan(spark):
    rows = mixture(3) + documents(random.Random(3), 0)
    docs = spark.createDataFrame([(*r, 9) for r in rows], DOCUMENTS + ", key int").repartition(4)
    want, got = defaultdict(int), defaultdict(int)
    for r in mixing.planned(docs).collect():
        want[r["doc_id"]] += r["copies"]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got[r["doc_id"]] += 1
    assert got == {k: v for k, v in want.items() if v}


def test_no_rows_and_no_words(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert mixing.planned(empty).collect() == [] and mixing.mixed_documents(empty).collect() == [] and mixing.drawn(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, "a", 1), (2, " ", None, None, 1)], DOCUMENTS)
    assert {(r["doc_id"], r["size"], r["target"], r["copies"]) for r in mixing.planned(blank).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    with pytest.raises(ValueError):
        mixing.planned(spark.createDataFrame(mixture(), DOCUMENTS))

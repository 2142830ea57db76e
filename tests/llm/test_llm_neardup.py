from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_tables import DOCUMENTS, documents, sentence

from coverbay.llm import neardup as n
from coverbay.llm.components import components


def edited(rng, text, share):
    words = text.split()
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = sentence(rng, words=1)
    return " ".join(words)


def corpus(seed=1):
    rng, rows = random.Random(seed), documents(random.Random(seed), 30)
    base = [sentence(rng, words=200) for _ in range(6)]
    line = sentence(rng, words=60)
    for i in range(240):
        text = rng.choice(base)
        kind = i % 4
        if kind == 0:
            text = edited(rng, text, rng.choice([0.005, 0.01, 0.02, 0.03]))
        elif kind == 1:
            text = text.upper() if i % 3 else text
        elif kind == 2:
            text = line + " " + sentence(rng, words=200)
        else:
            text = sentence(rng, words=80)
        rows.append((2000 + i, text, "en", "a", 1))
    return rows


def brute(rows, common=n.COMMON):
    """Class of each id: components of all pairs with weighted Jaccard similarity, equal texts and ids."""
    kept = [(r[0], r[1]) for r in rows if r[0] is not None]
    sets = list(n.shingles([None if t is None else t.encode() for _, t in kept]))
    all_sets = list(n.shingles([None if r[1] is None else r[1].encode() for r in rows]))
    df = Counter(x for s in all_sets for x in set(s.tolist()))
    often = sorted(k for k, v in df.items() if v > common * len(rows))
    weights = n.Weights(np.array(often, np.uint64), np.array([df[k] for k in often]), len(rows))
    parent = {i: i for i, _ in kept}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(kept)):
        for b in range(a):
            same = kept[a][1] is not None and kept[a][1] == kept[b][1]
            if same or (len(sets[a]) and len(sets[b]) and n.similarity(weights, sets[a], sets[b]) >= n.SIMILARITY):
                x, y = root(kept[a][0]), root(kept[b][0])
                parent[max(x, y)] = min(x, y)
    return Counter((i, root(i)) for i, _ in kept)


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], DOCUMENTS + ", node int, keys int").repartition(5)
    got = n.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == brute(rows)
    assert len({r["class_id"] for r in got}) < len(got) - 60


def test_rows_that_share_an_id_share_a_class(spark):
    rng = random.Random(8)
    a, b, c = (sentence(rng, words=50) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (7, b), (7, c), (9, c), (9, None), (11, None), (12, "x y")]
    got = n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 5: 1, 7: 1, 9: 1, 11: 11, 12: 12}
    assert len(got) == len(rows)


def test_keep_one(spark):
    rows = corpus(2)
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = n.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids.pop(None) == sum(r[0] is None for r in rows)
    assert ids == Counter({root for _, root in brute(rows)})


def test_common_shingles_are_counted_exactly(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(9)
    df = Counter(x for s in n.shingles([None if r[1] is None else r[1].encode() for r in rows]) for x in set(s.tolist()))
    values, counts = n.common_shingles(docs, len(rows))
    assert dict(zip(values.tolist(), counts.tolist())) == {k: v for k, v in df.items() if v > n.COMMON * len(rows)}


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(1)
    plain = n.Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64), 10)
    for share in (0.5, 0.8, 0.95):
        agree = []
        for _ in range(60):
            both = rng.integers(0, 2**63, int(400 * share), dtype=np.uint64)
            rest = 400 - len(both)
            a = np.sort(np.concatenate((both, both[:30], rng.integers(0, 2**63, rest // 2, dtype=np.uint64))))
            b = np.sort(np.concatenate((both, rng.integers(0, 2**63, rest - rest // 2, dtype=np.uint64))))
            sampled = [n.samples(v, plain.of(v, c)) for v, c in (n.counted(a), n.counted(b))]
            agree.append(np.mean(sampled[0] == sampled[1]) - n.similarity(plain, a, b))
        assert abs(np.mean(agree)) < 0.03


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = sentence(rng, words=200)
    rows = [(i, edited(rng, base, 0.01)) for i in range(600)]
    made = []
    compared = n._compared
    monkeypatch.setattr(n, "_compared", lambda pairs, *rest: made.append(pairs.count()) or compared(pairs, *rest))
    got = n.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}
    assert sum(made) < 600 * n.BANDS


def test_cells_find_links_that_the_first_node_lacks(spark, monkeypatch):
    rng = random.Random(9)
    base = sentence(rng, words=300)
    rows = [(i, edited(rng, base, 0.04)) for i in range(150)]
    rows += [(1000 + i, edited(rng, rows[i][1], 0.01)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute([(*r, None, None, None) for r in rows], n.COMMON)
    assert len({root for _, root in want}) > 5
    for cell in (256, 7):
        monkeypatch.setattr(n, "CELL", cell)
        got = Counter((r["doc_id"], r["class_id"]) for r in n.near_duplicates(docs).collect())
        assert sum((got - want).values()) <= 3  # pairs that share no bucket


def test_cells_and_slices_of_any_size_give_the_same_classes(spark, monkeypatch):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    monkeypatch.setattr(n, "SLICE", 3)
    monkeypatch.setattr(n, "CELL_BYTES", 4_000)
    got = n.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == brute(rows)


def test_cells_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(n, "CELL_BYTES", 100)
    rows = [(0, 7, i, 50, 0) for i in range(40)]
    members = spark.createDataFrame(rows, "band int, key long, node long, bytes long, rep long")
    cells = n._cells(members, spark.createDataFrame([], "node long, root long"))
    held = Counter((r["kind"], r["i"], r["j"]) for r in cells.collect())
    assert len(held) > 100 and max(held.values()) < 20


def test_pairs_of_a_hot_node_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(n, "SLICE", 4)
    found = [(i, np.arange(i, i + 20, dtype=np.uint64).tobytes()) for i in range(30)]
    shingled = spark.createDataFrame(found, "node long, found binary")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 30)] + [(5, 4), (9, 8)], "a long, b long")
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    got = n._compared(pairs, shingled, spark.sparkContext.broadcast(none)).collect()
    want = {(i, 0): max(0, 20 - i) / (40 - max(0, 20 - i)) for i in range(1, 30)} | {(5, 4): 19 / 21, (9, 8): 19 / 21}
    assert {(r["a"], r["b"]): r["similarity"] for r in got} == pytest.approx(want)


def test_empty(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert n.near_duplicates(empty).collect() == [] and n.keep_one(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    groups = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        groups[r["root"]].add(r["node"])
    want = defaultdict(set)
    for x in linked:
        want[root(x)].add(x)
    assert groups == want

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from llm_tables import DOCUMENTS, documents

from coverbay.llm import topk
from test_llm_decontaminate import words


def brute(rows, queries, k):
    counts = [Counter(words(text)) for _, text in rows]
    mean = sum(sum(c.values()) for c in counts) / len(rows)
    df = Counter(w for c in counts for w in c)
    out = {}
    for query_id, text in queries:
        scored = []
        for (doc_id, _), c in zip(rows, counts):
            size = sum(c.values())
            score = sum(
                math.log1p((len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (topk.K1 + 1) / (c[w] + topk.K1 * (1 - topk.B + topk.B * size / mean))
                for w in set(words(text))
                if w in c
            )
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[query_id] = [(doc_id, -score) for score, _, _, doc_id in sorted(scored)[:k]]
    return out


def results(spark, rows, queries, k=5, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, Score int").repartition(3)
    found = topk.search(docs, spark.createDataFrame(queries, "query_id long, text string"), k, **options)
    got = defaultdict(dict)
    for r in found.collect():
        got[r["query_id"]][r["rank"]] = (r["doc_id"], r["score"])
    return {q: [ranks[i + 1] for i in range(len(ranks))] for q, ranks in got.items()}


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 2000, "query_bytes": 4000}])
def test_search_equals_brute_force(spark, options):
    rows = [(r[0], r[1]) for r in documents(random.Random(1), 150) if r[0] != 908]
    queries = [(i, t) for i, t in rows if i is not None and i % 10 == 0] + [(5000, None), (5001, ""), (5002, "zzzzz"), (5003, "bo bo bo da")]
    want = {q: hits for q, hits in brute(rows, queries, 5).items() if hits}
    got = results(spark, rows, queries, **options)
    assert set(got) == set(want)
    for query, hits in want.items():
        assert [d for d, _ in got[query]] == [d for d, _ in hits]
        assert [x for _, x in got[query]] == pytest.approx([x for _, x in hits], rel=1e-12)


def test_blocks_below_the_bound_are_skipped():
    import numpy as np

    rng = random.Random(2)
    texts = [r[1].encode() for r in documents(rng, 3000) if r[1] and r[0] is not None and r[0] < 3000]
    shard = topk.Shard(np.arange(len(texts)), texts, 40.0)
    seen, plain = [], topk._ranges

    def counted(start, length):
        seen.append(int(length.sum()))
        return plain(start, length)

    topk._ranges = counted
    try:
        terms = np.unique(topk.word_hashes([texts[7]])[0])
        rows, _ = shard.best(terms, np.ones(len(terms)), 1)
    finally:
        topk._ranges = plain
    at = np.searchsorted(shard.terms, terms)
    postings = shard.entry[shard.term_entry[at + 1]] - shard.entry[shard.term_entry[at]]
    assert shard.ids[rows[0]] == 7
    assert sum(seen[1:]) < 0.9 * postings.sum()


def test_no_rows_and_no_queries(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    one = spark.createDataFrame([(1, "abc")], "query_id long, text string")
    assert topk.search(none, one).collect() == []
    assert topk.search(one.toDF("doc_id", "text"), one.where("false")).collect() == []


def test_equal_rows_pass_no_bar_twice(spark):
    """Copies tie: the smallest ids stay, over rounds, shards and tasks, and each task hands on k rows a query at most."""
    rows = [(i, "bo da ki bo") for i in range(400)] + [(i, f"bo ri{i} da la") for i in range(400, 500)] + [(None, "bo da ki bo")] * 3
    rng = random.Random(4)
    rng.shuffle(rows)
    queries = [(1, "bo da ki bo"), (2, "ri450 da"), (3, "la")]
    want = brute(rows, queries, 7)
    got = results(spark, rows, queries, 7, shard_bytes=600)
    for query, _ in queries:
        assert [d for d, _ in got[query]] == [d for d, _ in want[query]]


def test_bar_leaves_out_what_cannot_be_among_the_best():
    import numpy as np

    best = topk.Best(np.array([2.0, 0.0]), np.array([50, topk._NO_ID]), 2)
    best.add(0, np.array([49, 50, 51, 7]), np.array([2.0, 2.0, 2.0, 1.9]))
    assert best.rows[0][0].tolist() == [49]
    best.add(0, np.array([9, 8]), np.array([3.0, 3.0]))
    assert best.rows[0][0].tolist() == [8, 9] and (best.bar_score[0], best.bar_doc[0]) == (3.0, 9)
    best.add(1, np.array([1]), np.array([0.5]))
    assert best.batch(np.array([70, 80])).to_pydict() == {"query_id": [70, 70, 80], "doc_id": [8, 9, 1], "score": [3.0, 3.0, 0.5]}


def test_whole_lists_and_parts_of_lists_score_alike():
    import numpy as np

    texts = [r[1].encode() for r in documents(random.Random(5), 2000) if r[1]]
    shard = topk.Shard(np.arange(len(texts)), texts, 40.0)
    terms = np.unique(topk.word_hashes([texts[3]])[0])
    _, full = shard.best(terms, np.ones(len(terms)), len(texts))
    for k in (1, 5, 60):
        rows, scores = shard.best(terms, np.ones(len(terms)), k)
        least = np.sort(full)[-k]
        assert sorted(scores.tolist()) == sorted(full[full >= least].tolist())
        again, same = shard.best(terms, np.ones(len(terms)), k, least)
        assert again.tolist() == rows.tolist() and same.tolist() == scores.tolist()


def queries_of(texts):
    import numpy as np

    parts = [np.unique(topk.word_hashes([text])[0]) for text in texts]
    terms, number = np.unique(np.concatenate(parts), return_inverse=True)
    idf = np.random.default_rng(6).uniform(0.1, 3.0, len(terms))
    first = np.append(0, np.cumsum([len(part) for part in parts]))
    return topk.Queries(np.arange(len(texts)), first, number, terms, idf)


@pytest.mark.parametrize("limits", [{}, {"FREQUENT": 1}, {"FREQUENT": 10**6}, {"MOST_FREQUENT": 3, "TOGETHER": 7, "FEW": 2}, {"CELLS": 4096}, {"FREQUENT": 1, "POSTINGS": 3000}])
def test_many_queries_at_once_score_as_one(limits, monkeypatch):
    """What reaches the bars is the same to the last bit, whatever terms count as frequent and however queries are cut."""
    import numpy as np

    for name, value in limits.items():
        monkeypatch.setattr(topk, name, value)
    texts = [r[1].encode() for r in documents(random.Random(7), 1500) if r[1]]
    texts[40:80] = [texts[3]] * 40  # copies tie at the bar
    shard = topk.Shard(np.arange(len(texts)), texts, 40.0)
    queries = queries_of([*texts[:60], b"zz yy"])
    one = [dict(zip(*(x.tolist() for x in shard.best(*queries.words(q), len(texts))))) for q in range(61)]
    bar = np.array([sorted(scores.values())[-min(len(scores), 1 + 7 * q)] if scores else 1.0 for q, scores in enumerate(one)])
    got = [{} for _ in one]
    for query, rows, scores in shard.passing(queries, bar):
        got[query].update(zip(rows.tolist(), scores.tolist()))
    assert got == [{row: x for row, x in scores.items() if x >= least} for scores, least in zip(one, bar)]
    bar[:] = np.inf
    assert list(shard.passing(queries, bar)) == []


def test_searches_with_bars_read_few_postings(monkeypatch):
    """Once bars are known, only rare terms' lists and the documents that reach a bar are read, and blocks below it are skipped."""
    import numpy as np

    texts = [r[1].encode() for r in documents(random.Random(8), 3000) if r[1] and r[0] is not None and r[0] < 3000]
    shard = topk.Shard(np.arange(len(texts)), texts, 40.0)
    queries = queries_of(texts[:40])
    bar = np.array([np.sort(shard.best(*queries.words(q), 5)[1])[-5] for q in range(40)])
    seen, blocks, plain, reaching = [], [], topk._ranges, topk.Shard._reaching

    def counted(start, length):
        seen.append(int(length.sum()))
        return plain(start, length)

    def scored(self, block, matrix, score, kept, least):
        blocks.append(int(kept[:, block].sum()))
        return reaching(self, block, matrix, score, kept, least)

    monkeypatch.setattr(topk, "_ranges", counted)
    monkeypatch.setattr(topk.Shard, "_reaching", scored)
    assert {query for query, _, _ in shard.passing(queries, bar)} == set(range(40))
    _, at, _ = queries.within(queries.places(shard.terms), 0, 40)
    assert sum(seen) < 0.1 * (shard.entry[shard.term_entry[at + 1]] - shard.entry[shard.term_entry[at]]).sum()
    assert sum(blocks) < 0.9 * 40 * shard.blocks

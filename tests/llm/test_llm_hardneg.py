from __future__ import annotations

import math
import random

import numpy as np
import pytest

from coverbay.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, score string"


def whole(vector):
    return [math.floor(256 * x) for x in vector]


def usable(row):
    return row[0] is not None and row[1] is not None and row[2] is not None and all(x is not None and math.isfinite(x) for x in row[1])


def brute(rows, every=50):
    rows = [(vec_id, whole(vector), label) for vec_id, vector, label in filter(usable, rows)]
    out = []
    for me, (anchor, a, mine) in enumerate(rows):
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), vec_id, label) for i, (vec_id, b, label) in enumerate(rows) if i != me]
        for minus, positive, _ in sorted(s for s in scored if s[2] == mine)[:5]:
            fits = sorted(s for s in scored if s[2] != mine and 50 * -minus <= 100 * -s[0] <= 95 * -minus)
            out += [(anchor, positive, rank, s[1], -minus, -s[0]) for rank, s in enumerate(fits[:3], 1)]
    return sorted(out)


def table(rng, n, dims=6, labels=3):
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        near = centres[rng.randrange(labels)]
        vector = np.float32([x + rng.gauss(0, 0.4) for x in near]).tolist()
        rows.append((i, vector, label))
    return rows


def mined(spark, rows, every=50, parts=5):
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hardneg.mine(hardneg.typed(df), every).collect())


@pytest.mark.parametrize("values, anchors", [(1 << 20, 1024), (60, 3)])
def test_equals_brute_force(spark, monkeypatch, values, anchors):
    monkeypatch.setattr(hardneg, "ANCHORS", anchors)
    rng = random.Random(values)
    rows = table(rng, 400)
    write = hardneg.write_shards
    monkeypatch.setattr(hardneg, "write_shards", lambda rows, chosen: write(rows, chosen, values))
    got = mined(spark, rows, 20)
    assert got == brute(rows, 20) and len(got) > 100


def test_ties_repeats_and_copies(spark):
    rng = random.Random(3)
    rows = table(rng, 120, dims=4)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(60)]  # a group of copies
    rows += [(2000 + i, rows[1][1], (rows[0][2] + 1) % 3) for i in range(60)]
    rows += [rows[20], rows[20], (40, rows[40][1], rows[40][2])]  # repeated rows, of which two are anchors
    assert mined(spark, rows, 20) == brute(rows, 20)


def test_awkward_rows(spark):
    rng = random.Random(4)
    rows = table(rng, 150, dims=5)
    rows += [
        (None, rows[0][1], 1),
        (200, None, 1),
        (201, rows[0][1], None),
        (202, [1.0, None, 0.0, 0.0, 0.0], 1),
        (203, [math.nan, 0.0, 0.0, 0.0, 0.0], 1),
        (204, [math.inf, 0.0, 0.0, 0.0, 0.0], 1),
        (210, [], 1),
        (220, [0.0] * 5, 1),  # its scores are all 0
        (230, [0.5], 1),
        (240, [0.5] * 9, 2),
        (250, [-0.5] * 5, 0),
        (260, [3e6, -3e6, 1.0, 0.0, 0.0], 1),
        (270, [3e6, -3e6, 2.0, 0.0, 0.0], 1),
        (280, [2.5e6, -2e6, 2.0, 0.0, 0.0], 2),
    ]
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_scores_never_overflow(spark):
    rows = [(i, [3e38, -3e38, 1.0], i % 2) for i in range(6)]
    assert {r[4] for r in mined(spark, rows, 2)} == set()  # negatives score as positives do: outside the window
    assert hardneg.typed(spark.createDataFrame([(*r, 9, "x") for r in rows], SCHEMA)).first()["vector"][0] > 10**9


def test_one_label_and_no_rows(spark):
    assert mined(spark, [(i, [1.0, i / 9], 1) for i in range(60)]) == []
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []


def test_the_search_stops_early():
    """Few rows are met where one component decides, and no better row is left unseen."""
    rng = np.random.default_rng(5)
    rows = rng.integers(-20, 20, (4000, 4))
    rows[:, 0] = rng.integers(-20000, 20000, 4000)
    shard = hardneg.Shard.of("s", np.arange(4000), np.zeros(4000, int), list(rows))
    vector = np.array([[3, 1, -1, 0]])
    none, most = np.array([[hardneg._NONE]]), np.array([[np.iinfo(np.int64).max]])
    block = hardneg.Anchors(vector, np.array([0]), np.array(["other"], object), np.array([0]), none, most, True, 5)
    met = hardneg.search(shard, block)
    want = sorted((-int(s), i) for i, s in enumerate(rows @ vector[0]))[:5]
    assert [(-s, i) for _, s, i in block.best[0].rows.T.tolist()] == want
    assert met < 400

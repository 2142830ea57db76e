from __future__ import annotations

import random
from types import SimpleNamespace

import pytest

from coverbay.llm.shared import row_numbers, shared_folder


def session(master, settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=SimpleNamespace(master=master))


def test_a_cluster_names_its_shared_folder():
    assert shared_folder(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077", {}))


def test_row_numbers_are_places_in_the_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "É", "é"]), rng.choice([None, *range(5)]), "x", 1) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, part string, tie int").repartition(6)
    got = row_numbers(df, ["k", "n"]).orderBy("row").collect()
    assert [r["row"] for r in got] == list(range(400))
    order = [(r["k"] is not None, (r["k"] or "").encode(), r["n"] is not None, r["n"] or 0) for r in got]
    assert order == sorted(order)
    assert row_numbers(df.limit(0), ["k"]).collect() == []

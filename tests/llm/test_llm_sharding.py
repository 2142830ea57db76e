from __future__ import annotations

import random
import zlib

from llm_tables import DOCUMENTS, documents

from coverbay.llm import sharding


def brute(rows, shards):
    """(doc_id, size, crc, shard, slot), by the middle of each row on the line of all bytes."""
    keyed = []
    for doc_id, text in rows:
        data = (text or "").encode()
        crc = None if text is None else zlib.crc32(data)
        keyed.append((doc_id is not None, doc_id or 0, crc is not None, crc or 0, len(data) + 1, doc_id, crc))
    keyed.sort()
    total, at, out, slots = sum(k[4] for k in keyed), 0, [], {}
    for *_, size, doc_id, crc in keyed:
        shard = (2 * at + size) * shards // (2 * total)
        at += size
        out.append((doc_id, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    return sorted(out, key=str)


def test_numbered_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in documents(random.Random(1), 300)]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, shard string, size int").repartition(7)
    got = sorted((tuple(r) for r in sharding.numbered(docs, 8).collect()), key=str)
    assert got == brute(rows, 8)


def test_a_hot_run_of_equal_rows_is_cut(spark):
    rows = [(5, "same text")] * 4000 + [(i, "other") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.numbered(docs, 4).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 20


def test_assigned_agrees_and_keeps_columns(spark):
    rows = [(r[0], r[1]) for r in documents(random.Random(2), 200)]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, Shard string")
    got, name = sharding.assigned(docs, 5)
    assert name == "shard_" and got.columns == [*docs.columns, "shard_"]
    want = sorted((str(r[0]), r[1], r[3]) for r in brute(rows, 5))
    assert sorted((str(r[0]), len((r[1] or "").encode()) + 1, r[3]) for r in got.collect()) == want


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert [tuple(r) for r in sharding.numbered(one, 8).collect()] == [(1, 4, zlib.crc32(b"abc"), 4, 0)]
    none = spark.createDataFrame([], DOCUMENTS)
    assert sharding.numbered(none).collect() == []
    assert sharding.assigned(none)[0].collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    plan = sharding.numbered(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

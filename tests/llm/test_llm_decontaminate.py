from __future__ import annotations

import random
import re

from llm_tables import DOCUMENTS, documents, sentence

from coverbay.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items):
    out = []
    for doc_id, text in rows:
        have, hit, found = words(text), set(), set()
        for item_id, body in items:
            item = words(body)
            size = min(13, len(item))
            for start in range(len(item) - size + 1) if item else ():
                for at in range(len(have) - size + 1):
                    if have[at : at + size] == item[start : start + size]:
                        hit |= set(range(at, at + size))
                        found.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(have), len(hit), sorted(found)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    items = [(i, sentence(rng, words=n)) for i, n in enumerate((1, 5, 12, 13, 14, 30, 60))]
    items += [(None, sentence(rng, words=20)), (8, None), (9, ""), (10, "?!"), (3, items[3][1])]
    rows = [(r[0], r[1]) for r in documents(rng, 20)]
    for i in range(40):
        item = words(rng.choice(items[:8])[1])
        cut = item[rng.randrange(0, 3) :][: rng.randrange(5, 40)]
        text = sentence(rng, words=rng.randrange(0, 30)) + " " + " ".join(cut).upper() + ". " + sentence(rng, words=rng.randrange(0, 9))
        rows.append((1000 + i, text if i % 4 else text + " | " + text))
    return rows, items


def test_repeated_items_fill_no_block(spark):
    items = [(1, "some words " * 50)] * 200 + [(2, "other words"), (None, "other words"), (3, None)]
    blocks = list(d._blocks(spark.createDataFrame(items, "item_id long, text string"), 4_000))
    assert sorted(len(b) for b in blocks if b)[-1] <= 3 and sum(map(len, blocks)) == 3


def found(spark, rows, items, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got, name = d.annotate(docs, spark.createDataFrame(items, "item_id long, text string"), **options)
    assert name["n_words"] == "n_words_"
    picked = got.select("doc_id", name["n_words"], d.hit_words(name["spans"]), name["items"]).collect()
    return sorted(((r[0], r[1], r[2], r[3]) for r in picked), key=str)


def test_annotate_equals_brute_force(spark):
    rows, items = cases()
    want = brute(rows, items)
    assert sum(r[2] > 0 for r in want) > 15
    assert found(spark, rows, items) == want


def test_small_shards_and_many_blocks_change_nothing(spark):
    rows, items = cases()
    rows = [r for r in rows if len(r[1] or "") < 5000]
    assert found(spark, rows, items, shard_bytes=500, block_bytes=1500) == brute(rows, items)


def test_remove_contaminated(spark):
    rng = random.Random(2)
    item = sentence(rng, words=13)
    rows = [(1, item), (2, item + " " + sentence(rng, words=247)), (3, item + " " + sentence(rng, words=248)), (4, None), (4, "")]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, spans string")
    kept = d.remove_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 4]


def test_longest_matches(spark):
    rng = random.Random(3)
    a, b = sentence(rng, words=30), sentence(rng, words=8)
    rows = [(5, "zzz " + " ".join(a.split()[4:21]) + " zzz"), (6, " ".join(a.split()[2:9])), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, a), (2, b), (3, "qqqq"), (4, None)], "item_id long, text string")
    got = {r["item_id"]: tuple(r)[1:] for r in d.longest_matches(docs, items).collect()}
    assert got["1"] == (17, 4, 5, 1)
    assert got["3"] == (0, None, None, None)
    assert set(got) == {"1", "2", "3"}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], "item_id long, text string")
    assert d.annotate(docs, items)[0].collect() == []
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert d.remove_contaminated(one, items).count() == 1
    assert d.longest_matches(one, items).collect() == []

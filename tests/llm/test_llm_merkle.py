from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from llm_tables import DOCUMENTS, documents
from pyspark.sql import functions as F

from coverbay.llm import merkle
from coverbay.llm.shared import remainder


def h(text):
    return sha256(text.encode()).hexdigest()


def hash_row(row, lower):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def climb(nodes):
    """The root, and for each leaf the list of (siblings to the left, to the right) up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            first = place // 8 * 8
            paths[leaf].append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + 8])))
            at[leaf] = place // 8
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    by_lang = defaultdict(list)
    for row in rows:
        lower = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, hash_row(row, False), hash_row(row, lower), row[0]))
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = []
    for lang in langs:
        leaves = sorted(by_lang[lang], key=lambda leaf: leaf[:4])
        trees.append((leaves, *climb([leaf[2] for leaf in leaves])))
    root, tops = climb([tree[1] for tree in trees])
    out = []
    for (leaves, subroot, paths), top in zip(trees, tops):
        for (_, _, leaf, claimed, doc_id), path in zip(leaves, paths):
            folded = claimed
            for left, right in path + top:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path + top))
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def proved(spark, rows, parts=5):
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], DOCUMENTS + ", leaf string, tree int").repartition(parts)
    return sorted((tuple(r) for r in merkle.proofs(merkle.build(docs, remainder(F.col("doc_id"), 3) == 0)).collect()), key=str)


@pytest.mark.parametrize("block", [1, 5, 8192])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, f"Text {i} É", rng.choice(["en", "en", "en", "fr", "", None]), None, i) for i in range(150)] + documents(rng, 5)
    rows += [(1000 + i, "A", f"lang{i}", "s", 1) for i in range(12)]  # trees of one leaf, two levels of subroots
    got = proved(spark, rows)
    assert got == brute(rows)
    assert {row[6] for row in got} == {True, False}


def test_one_row_and_none(spark):
    assert proved(spark, [(1, "a", "en", "s", 1)]) == brute([(1, "a", "en", "s", 1)])
    assert proved(spark, []) == []


def test_equal_rows_may_be_most_of_the_table(spark):
    rows = [(7, "Same", "en", "s", 4)] * 300 + [(i, "other", "en", "s", 5) for i in range(20)]
    assert proved(spark, rows, 7) == brute(rows)


def test_missing_is_what_the_paths_need_and_no_more():
    for size in (1, 2, 8, 9, 64, 65, 100, 513):
        for low in range(0, size, 7):
            for high in range(low, size, 11):
                needed, n, level = set(), size, 0
                mine = set(range(low, high + 1))
                while n > 1:
                    needed |= {(level, i) for p in {i // 8 for i in mine} for i in range(8 * p, min(8 * p + 8, n)) if i not in mine}
                    mine, n, level = {i // 8 for i in mine}, -(-n // 8), level + 1
                found = list(merkle.missing(low, high, size))
                assert len(found) == len(set(found)) and set(found) == needed


def test_a_partition_fetches_each_node_once(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 50)
    docs = spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(400)], DOCUMENTS)
    nodes = merkle.fetched(merkle.build(docs, F.lit(False))).collect()
    keys = [(r["block"], r["tree"], r["level"], r["index"]) for r in nodes]
    assert len(keys) == len(set(keys)) == sum(len(list(merkle.missing(b * 50, b * 50 + 49, 400))) for b in range(8))


def test_a_changed_text_is_found(spark):
    rows = [(i, "UPPER" if i % 2 else "lower", "en", "s", 1) for i in range(40)]
    got = {r[0]: r[6] for r in proved(spark, rows)}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(40)}

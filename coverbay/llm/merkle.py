"""Merkle trees over the documents of each language, and a proof for every document.

Leaves are hashed by Spark's functions, put in the order of (lang, doc_id) by a range partitioning and
numbered by prefix sums of the partitions' counts. Each level of the trees is one aggregate over runs of
``ARITY`` nodes and is stored: that table of nodes is the manifest. The languages' subroots, in order,
are the leaves of one more tree.

Proofs are made per leaf partition, ``BLOCK`` consecutive rows. Its multiproof is the least set of nodes
from which, with its own leaves, all its paths can be computed: on every level the members of the first
and last run that lie outside the partition (``missing``). These coordinates are fetched once, by one
join with the manifest; the task derives all nodes its paths share and writes out each leaf's siblings,
so a node is sent once to a partition and not once to every proof. A partition's rows and nodes are
bounded by ``BLOCK`` and the depth.

H is the lowercase hex SHA-256 of concatenated hex digests. A field is ``-`` if it is NULL, else its
UTF-8 length, ``:`` and its value. A tree of one leaf is that leaf; a last run may hold one node. Rows
with equal or missing ids are leaves too, in the order of their digests, missing ids first; equal rows
are equal leaves. A proof without siblings is the hash of nothing. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from coverbay.llm.shared import materialise, row_numbers, stored

ARITY = 8
BLOCK = 8192
#: The tree over the subroots, beside the languages' trees 0, 1, …
TOP = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``leaves`` (doc_id, leaf, claimed, row, tree, index, size), ``nodes`` (tree, level, index, size, digest), number of trees."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    parts = [_field(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*parts, _field(text)).cast("binary"), 256)


def tampered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hashed(documents: DataFrame, tamper: Column) -> DataFrame:
    """(doc_id, lang, leaf, claimed): ``claimed`` is the leaf of what is shown to be checked."""
    text = F.col("text")
    claimed = F.when(tamper, leaf(tampered(text))).otherwise(F.col("leaf"))
    return documents.withColumn("leaf", leaf(text)).select("doc_id", "lang", "leaf", claimed.alias("claimed"))


def _parents(level: DataFrame) -> DataFrame:
    run = F.array_sort(F.collect_list(F.struct("index", "digest")))  # ARITY members at most
    joined = F.array_join(F.transform(run, lambda member: member["digest"]), "")
    grouped = level.where("size > 1").groupBy("tree", F.expr(f"index div {ARITY}").alias("parent"))
    return grouped.agg(
        F.sha2(joined.cast("binary"), 256).alias("digest"),
        F.expr(f"(max(size) + {ARITY - 1}) div {ARITY}").alias("size"),
    ).select("tree", F.col("parent").alias("index"), "size", "digest")


def _levels(level: DataFrame, largest: int) -> list[DataFrame]:
    """All levels of the trees from their leaves (tree, index, size, digest); each is stored."""
    levels = [level]
    while largest > 1:
        levels.append(stored(_parents(levels[-1])))
        largest = -(-largest // ARITY)
    return levels


def _tagged(levels: list[DataFrame]) -> Iterator[DataFrame]:
    for number, level in enumerate(levels):
        yield level.select("tree", F.lit(number).alias("level"), "index", "size", "digest")


def build(documents: DataFrame, tamper: Column) -> Manifest:
    """The trees of all documents; ``tamper`` says whose claimed text has its A-Z in lower case."""
    rows = row_numbers(materialise(hashed(documents, tamper)), ["lang", "doc_id", "leaf", "claimed"])
    rows = stored(rows)
    languages = rows.groupBy("lang").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("size"))
    languages = stored(row_numbers(languages, ["lang"], "tree"))
    bounds = languages.agg(F.max("size"), F.count(F.lit(1))).first()
    same = rows["lang"].eqNullSafe(languages["lang"])
    leaves = rows.join(languages, same).select(
        "doc_id", "leaf", "claimed", "row", "tree", (F.col("row") - F.col("first")).alias("index"), "size"
    )
    leaves = stored(leaves)
    trees = _levels(leaves.select("tree", "index", "size", F.col("leaf").alias("digest")), bounds[0] or 0)
    subroots = [level.where("size = 1").select("tree", "digest") for level in trees]
    top = subroots[0]
    for more in subroots[1:]:
        top = top.unionAll(more)
    count = F.lit(bounds[1]).cast("long").alias("size")
    top = stored(top.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"), count, "digest"))
    nodes = None
    for level in [*_tagged(trees), *_tagged(_levels(top, bounds[1]))]:
        nodes = level if nodes is None else nodes.unionAll(level)
    return Manifest(leaves, nodes, bounds[1])


def missing(low: int, high: int, size: int) -> Iterator[tuple[int, int]]:
    """(level, index) of the nodes that, with leaves low..high of a tree of ``size``, give all their paths."""
    level = 0
    while size > 1:
        for index in range(low // ARITY * ARITY, low):
            yield level, index
        for index in range(high + 1, min(high // ARITY * ARITY + ARITY, size)):
            yield level, index
        low, high, size, level = low // ARITY, high // ARITY, -(-size // ARITY), level + 1


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            (block, tree, level, index)
            for block, tree, low, high, size in zip(*(column.to_pylist() for column in batch.columns))
            for level, index in missing(low, high, size)
        ]
        kinds = [("block", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("index", pa.int64())]
        arrays = [pa.array([row[i] for row in found], kind) for i, (_, kind) in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])


def fetched(manifest: Manifest) -> DataFrame:
    """(block, tree, level, index, digest): the multiproof of every leaf partition, each node once."""
    block = F.expr(f"row div {BLOCK}").alias("block")
    ranges = manifest.leaves.groupBy(block, "tree").agg(
        F.min("index").alias("low"), F.max("index").alias("high"), F.max("size").alias("size")
    )
    tops = manifest.leaves.groupBy(block).agg(F.min("tree").alias("low"), F.max("tree").alias("high"))
    top = F.lit(TOP).cast("long").alias("tree")
    tops = tops.select("block", top, "low", "high", F.lit(manifest.trees).cast("long").alias("size"))
    schema = "block long, tree long, level int, index long"
    wanted = stored(ranges.unionAll(tops).mapInArrow(_coordinates, schema))
    return wanted.join(manifest.nodes.drop("size"), ["tree", "level", "index"])


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class _Paths:
    """The nodes of one tree that a partition's paths touch, and the siblings above each of them."""

    def __init__(self, low: int, own: list[str], size: int, given: dict[tuple[int, int], str]):
        self.levels, self.sizes, self._above = [], [size], {}
        known = dict(enumerate(own, low))
        high = low + len(own) - 1
        while True:
            level = len(self.levels)
            for index in (*range(low // ARITY * ARITY, low), *range(high + 1, min(high // ARITY * ARITY + ARITY, size))):
                known[index] = given[level, index]
            self.levels.append(known)
            if size == 1:
                break
            low, high = low // ARITY, high // ARITY
            known = {parent: _hash("".join(self._run(level, parent))) for parent in range(low, high + 1)}
            size = -(-size // ARITY)
            self.sizes.append(size)

    def _run(self, level: int, parent: int) -> list[str]:
        known = self.levels[level]
        return [known[i] for i in range(parent * ARITY, min(parent * ARITY + ARITY, self.sizes[level]))]

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, index: int, level: int = 0) -> str:
        """The siblings of a node and of all above it, level by level, left to right."""
        if self.sizes[level] == 1:
            return ""
        run = self._run(level, index // ARITY)
        del run[index % ARITY]
        above = level + 1, index // ARITY
        if above not in self._above:
            self._above[above] = self.siblings(above[1], above[0])
        return "".join(run) + self._above[above]

    def fold(self, index: int, digest: str) -> str:
        """The root that follows from ``digest`` at ``index`` and the siblings."""
        for level, size in enumerate(self.sizes):
            if size == 1:
                return digest
            run = self._run(level, index // ARITY)
            run[index % ARITY] = digest
            digest, index = _hash("".join(run)), index // ARITY
        return digest


def _prove(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
    given: dict[int, dict[tuple[int, int], str]] = {}
    for tree, level, index, digest in zip(*(nodes[name].to_pylist() for name in ("tree", "level", "index", "digest"))):
        given.setdefault(tree, {})[level, index] = digest
    leaves = leaves.sort_by("row")
    names = ("tree", "index", "size", "trees", "doc_id", "leaf", "claimed")
    rows = list(zip(*(leaves[name].to_pylist() for name in names)))
    own: dict[int, list[tuple]] = {}
    for row in rows:
        own.setdefault(row[0], []).append(row)
    trees = {
        tree: _Paths(part[0][1], [row[5] for row in part], part[0][2], given.get(tree, {})) for tree, part in own.items()
    }
    top = _Paths(rows[0][0], [paths.root for paths in trees.values()], rows[0][3], given.get(TOP, {}))
    out = []
    for tree, index, _, _, doc_id, digest, claimed in rows:
        paths = trees[tree]
        folded = top.fold(tree, paths.fold(index, claimed))
        proof = _hash(paths.siblings(index) + top.siblings(tree))
        out.append((doc_id, digest, paths.root, top.root, proof, folded, folded == top.root))
    arrays = [pa.array([row[0] for row in out], pa.int64())]
    arrays += [pa.array([row[i] for row in out], pa.string()) for i in range(1, 6)]
    return pa.Table.from_arrays([*arrays, pa.array([row[6] for row in out], pa.bool_())], _PROVED)


_PROVED = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    folded_root is computed from the claimed leaf and the siblings of the original tree.
    """
    nodes = fetched(manifest)
    block = F.expr(f"row div {BLOCK}").alias("block")
    leaves = manifest.leaves.select("*", block, F.lit(manifest.trees).cast("long").alias("trees"))
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return leaves.groupBy("block").cogroup(nodes.groupBy("block")).applyInArrow(_prove, schema)

"""Near duplicates: weighted min-hashing of TF-IDF shingles by improved consistent weighted sampling.

A shingle is five consecutive words (A-Z lower-cased; digits, letters and anything beyond ASCII make
words); a text of fewer words is one shingle. It weighs its count in the text times its idf. Two
texts are linked if their weighted Jaccard similarity (sum of the smaller weights over sum of the
larger ones) is ``SIMILARITY`` or more. A class is a set of texts connected by links.

1. idf. ``idf`` is 1 for a shingle in at most ``COMMON`` of the rows and falls with the logarithm of
   its frequency to ``LEAST_IDF`` for one in all rows. So only common shingles need a count, and there
   are few: see ``common_shingles``. Counts are exact and cover all rows.
2. Sampling. ``BANDS * ROWS`` consistent samples per text; two texts agree in one with a probability
   equal to their similarity. Texts that agree in all samples of a band share a bucket. A pair at
   0.8 is missed by all bands with probability 0.002, at 0.85 with 0.0001.
3. Verification. Equal texts are one node, the smallest id that has the text. In each bucket all
   nodes are compared with the bucket's smallest one, and components are built from the links. Where a
   bucket still holds several components, the nodes outside the first one's component are compared
   with all other nodes of the bucket, in cells of at most about ``2 * CELL`` nodes and
   ``2 * CELL_BYTES`` bytes of text (or two texts that are longer); a cell gives only the links that
   join components. So no link between texts that share a bucket is lost, and no pairs are listed
   within a component, however large. A node that meets more than ``SLICE`` others is met in several
   tasks, each with its own copy of the node's text.

Results carry ``doc_id``. NULL and empty texts: a text without words is only the copy of an equal
text; NULL is a copy of nothing, each such row a class of its own. Rows without an id have no class.
Rows that share an id are one document, linked by any of their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from coverbay.llm.components import components
from coverbay.llm.features import texts_of
from coverbay.llm.shared import fresh, materialise, stored
from coverbay.llm.wordhash import mixed, portions, shingle_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
COMMON = 0.01
LEAST_IDF = 0.5
CELL = 256
CELL_BYTES = 8 << 20
SLICE = 256  # pairs with one node that stay together

_SEEDS = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Sorted shingle hashes of each text, repeats kept."""
    for _, some in portions(texts):
        hashes, first = word_hashes(some)
        for start, end in zip(first[:-1], first[1:]):
            yield np.sort(shingle_hashes(hashes[start:end], SHINGLE))


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and counts of a sorted array."""
    head = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))[: len(found)])
    return found[head], np.diff(np.concatenate((head, [len(found)])))


def _batch_counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a batch and the number of its texts that have them."""
    sets = [counted(found)[0] for found in shingles(texts)]
    return counted(np.sort(np.concatenate(sets))) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _pairs(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["shingle", "n"])


def common_shingles(documents: DataFrame, rows: int, common: float = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in more than ``common`` of the rows, ascending, and the number of rows that have them.

    First pass: each batch of rows reports the shingles in more than half of ``common`` of its rows.
    Batches that don't report a shingle can hold at most half of ``common`` of all rows between them,
    so a shingle is a candidate only if the reports add up to more than the other half. A row adds
    to at most as many sums as it has shingles, hence there are at most 2 / common times the mean
    number of shingles of a row: a bound that doesn't grow with the rows. Second pass: the candidates,
    broadcast, are counted exactly.
    """
    least = common / 2

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = _batch_counts(texts_of(batch))
            often = counts > least * batch.num_rows
            yield _pairs(values[often], counts[often])

    texts = documents.select("text")
    reported = texts.mapInArrow(report, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = np.array([r["shingle"] for r in reported.where(F.col("n") > least * rows).collect()], np.int64)
    candidates = np.sort(found.view(np.uint64))
    shared = documents.sparkSession.sparkContext.broadcast(candidates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            values, counts = _batch_counts(texts_of(batch))
            at = np.searchsorted(values, wanted)
            here = at < len(values)
            here[here] = values[at[here]] == wanted[here]
            total[here] += counts[at[here]]
        yield _pairs(wanted[total > 0], total[total > 0])

    if not len(candidates):
        return candidates, np.zeros(0, np.int64)
    exact = texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    kept = exact.where(F.col("n") > common * rows).collect()
    values = np.array([r["shingle"] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], np.array([r["n"] for r in kept], np.int64)[order]


class Weights:
    """Shingle weights: count in the text times idf."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, rows: int):
        self.values = values
        share = np.log(rows / np.maximum(counts, 1)) / math.log(1 / COMMON) if rows else counts.astype(float)
        self.idf = LEAST_IDF + (1 - LEAST_IDF) * np.clip(share, 0, 1)

    def of(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = counts.astype(np.float64)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, found), len(self.values) - 1)
            weight *= np.where(self.values[at] == found, self.idf[at], 1.0)
        return weight


def similarity(weights: Weights, mine: np.ndarray, theirs: np.ndarray) -> float:
    """Weighted Jaccard similarity of two arrays of shingles, repeats counted."""
    (a, n), (b, m) = counted(mine), counted(theirs)
    v, w = weights.of(a, n), weights.of(b, m)
    at = np.searchsorted(b, a)
    both = at < len(b)
    both[both] = b[at[both]] == a[both]
    shared = np.minimum(v[both], w[at[both]]).sum()
    total = v.sum() + w.sum() - shared
    return float(shared / total) if total else 0.0


def samples(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One consistent weighted sample (shingle and its level) per seed, as a hash.

    For a shingle of weight S, r and c are Gamma(2, 1) and b is uniform, all from the shingle's hash;
    t = floor(ln S / r + b), ln a = ln c - r (t - b + 1). The shingle with the least a is the sample.
    """
    k = BANDS * ROWS
    best, sample = np.full(k, np.inf, np.float32), np.zeros(k, np.uint64)
    log_weight = np.log(weight).astype(np.float32)
    tiny = np.float32(2.0**-33)
    for start in range(0, len(found), 1024):
        value, level = found[start : start + 1024, None], log_weight[start : start + 1024, None]
        x = (value ^ _SEEDS[None, :k]) * _STEP
        x ^= x >> np.uint64(32)
        x *= _SEEDS[None, k:] | np.uint64(1)
        y = (x ^ (x >> np.uint64(29))) * _STEP
        halves = x.view(np.uint32).reshape(*x.shape, 2)
        scale = np.float32(2.0**-32)
        logs = np.log(halves * scale + tiny)
        ln_c = np.log(-(logs[..., 0] + logs[..., 1]))
        logs = np.log((y >> np.uint64(48)).astype(np.float32) * np.float32(2.0**-16) + np.float32(2.0**-17))
        logs += np.log(((y >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2.0**-16) + np.float32(2.0**-17))
        r = -logs
        b = (y & np.uint64(0xFFFFFFFF)).astype(np.float32) * scale
        t = np.floor(level / r + b)
        ln_a = ln_c - r * (t - b + 1)
        at = ln_a.argmin(0)
        columns = np.arange(k)
        less = ln_a[at, columns] < best
        best[less] = ln_a[at, columns][less]
        taken = found[start + at] + t[at, columns].astype(np.int64).view(np.uint64) * _STEP
        sample[less] = taken[less]
    return sample


def band_keys(found: np.ndarray, weights: Weights) -> np.ndarray | None:
    if not len(found):
        return None
    value, count = counted(found)
    picked = mixed(samples(value, weights.of(value, count))).reshape(BANDS, ROWS)
    key = np.zeros(BANDS, np.uint64)
    for row in range(ROWS):
        key = key * _STEP + picked[:, row]
    return mixed(key).view(np.int64)


def _signed(documents: DataFrame, weights) -> DataFrame:
    """(doc_id, digest, bytes, keys): the text's MD5, length and bucket in each band; no keys without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(*weights.value)
        for batch in batches:
            keys = [band_keys(found, own) for found in shingles(texts_of(batch))]
            column = pa.array([None if k is None else k for k in keys], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], column], ["doc_id", "digest", "bytes", "keys"])

    kept = documents.where("doc_id is not null and text is not null")
    kept = kept.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("digest"), F.octet_length("text").cast("long").alias("bytes"), "text")
    return kept.mapInArrow(run, "doc_id long, digest binary, bytes long, keys array<long>")


def _shingled(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, found): the shingles of the documents in ``wanted`` (node), eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in shingles(texts_of(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "found"])

    texts = documents.select(F.col("doc_id").cast("long").alias("node"), "text")
    return texts.join(wanted, "node", "left_semi").mapInArrow(run, "node long, found binary")


def _compared(pairs: DataFrame, shingled: DataFrame, weights) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(*weights.value)
        for batch in batches:
            mine, theirs = (batch.column(i).to_pylist() for i in (2, 3))
            got = [similarity(own, np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(mine, theirs)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(got, pa.float64())], ["a", "b", "similarity"])

    pairs = materialise(pairs)
    hot = stored(pairs.groupBy("b").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices")).where("slices > 1"))
    slices = F.coalesce("slices", F.lit(1))
    sliced = pairs.join(hot, "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), slices).cast("int").alias("slice"))
    theirs = shingled.toDF("b", "theirs").join(hot, "b", "left")
    theirs = theirs.select("b", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), "theirs")
    joined = sliced.join(shingled.toDF("a", "mine"), "a").join(theirs, ["b", "slice"])
    found = joined.select("a", "b", "mine", "theirs").mapInArrow(run, "a long, b long, similarity double")
    return materialise(found.groupBy("a", "b").agg(F.max("similarity").alias("similarity")))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, class_id, text_id): one row per row of ``documents`` that has an id.

    ``class_id`` is the smallest id of the class, ``text_id`` the smallest id with an equal text.
    """
    rows = documents.count()
    context = documents.sparkSession.sparkContext
    weights = context.broadcast((*common_shingles(documents, rows), rows))
    signed = materialise(_signed(documents, weights))
    nodes = materialise(signed.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bytes").alias("bytes"), F.first("keys").alias("keys")))
    members = _members(nodes)
    shingled = materialise(_shingled(documents, members.select("node").distinct()))
    roots = _linked(members, shingled, weights)
    named = signed.select("doc_id", "digest").join(nodes.select("digest", "node"), "digest").select("doc_id", "node")
    empty = documents.where("doc_id is not null and text is null").select(F.col("doc_id").cast("long").alias("doc_id"))
    named = named.union(empty.select("doc_id", F.col("doc_id").alias("node")))
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    if not several.isEmpty():
        same = named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
        roots = components(same.union(roots.toDF("a", "b")))
    return _rooted(named, roots, "node", "class_id").select("doc_id", "class_id", F.col("node").alias("text_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, with their own columns: of each class the one whose id names it.

    Rows without an id stay. Of rows that share that id, the one with the least text hash stays.
    """
    classes = near_duplicates(documents)
    kept = classes.where("doc_id = class_id").select("doc_id").distinct()
    out = documents.join(kept, "doc_id", "left_semi").select(documents.columns)
    if not classes.groupBy("doc_id").count().where("count > 1").isEmpty():
        name = fresh(documents.columns, "row")
        order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
        out = out.withColumn(name, F.row_number().over(order)).where(F.col(name) == 1).drop(name)
    return out.union(documents.where("doc_id is null"))


def _members(nodes: DataFrame) -> DataFrame:
    """(band, key, node, bytes, rep) of the buckets with several nodes; rep is the smallest of them."""
    buckets = nodes.where("keys is not null").select("node", "bytes", F.posexplode("keys").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.min("node").alias("rep"), F.max("node").alias("last")).where("rep < last")
    return materialise(buckets.join(shared.drop("last"), ["band", "key"]))


def _rooted(frame: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """``frame`` with the root of its column ``node``, which is itself where it has no link."""
    joined = frame.join(roots.toDF(node, "_root"), node, "left")
    return joined.withColumn(root, F.coalesce("_root", node)).drop("_root")


def _linked(members: DataFrame, shingled: DataFrame, weights) -> DataFrame:
    """(node, root) of all nodes with a link."""
    pairs = members.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    links = _compared(pairs, shingled, weights).where(F.col("similarity") >= SIMILARITY).select("a", "b")
    roots = components(links)
    more = materialise(_joined_cells(_cells(members, roots), shingled, weights))
    if more.isEmpty():
        return roots
    # the components so far are stars around their roots; the new links join some of them
    return components(more.union(roots.toDF("a", "b")))


def _cells(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, key, kind, i, j, node, root, first): the nodes of each cell of the buckets with several components.

    Nodes of the first node's component and the rest are dealt to chunks by hash. Cells of kind 0 hold
    a chunk of the rest and one of the others, kind 1 two chunks of the rest. ``first`` marks nodes to
    be compared with those that are not.
    """
    rooted = _rooted(_rooted(members, roots, "node", "root"), roots, "rep", "rep_root")
    rooted = rooted.select("band", "key", "node", "bytes", "root", (F.col("root") == F.col("rep_root")).alias("main"))
    rooted = materialise(rooted)
    length = lambda test: F.coalesce(F.sum(F.when(test, F.col("bytes"))), F.lit(0))
    chunks = lambda test: F.ceil(F.greatest(F.count_if(test) / CELL, length(test) / CELL_BYTES)).cast("int")
    sizes = rooted.groupBy("band", "key").agg(chunks(F.col("main")).alias("mains"), chunks(~F.col("main")).alias("rests"))
    dealt = rooted.join(sizes.where("rests > 0"), ["band", "key"])
    spread = F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    dealt = dealt.withColumn("chunk", spread)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = ["band", "key"]
    columns = [*own, "kind", "i", "j", "node", "root", "first"]
    mains = dealt.where("main").select("*", every("rests").alias("j")).withColumnsRenamed({"chunk": "i"})
    rests = dealt.where("not main").select("*", every("mains").alias("i")).withColumnsRenamed({"chunk": "j"})
    mixed = mains.withColumn("first", F.lit(False)).unionByName(rests.withColumn("first", F.lit(True))).withColumn("kind", F.lit(0))
    among = dealt.where("not main").select("*", every("rests").alias("other"))
    among = among.withColumns({"kind": F.lit(1), "i": F.least("chunk", "other"), "j": F.greatest("chunk", "other"), "first": F.lit(True)})
    return mixed.select(columns).union(among.select(columns))


def _joined_cells(cells: DataFrame, shingled: DataFrame, weights) -> DataFrame:
    """(a, b): links that join components, from the comparisons in each cell."""

    def run(cell: pa.Table) -> pa.Table:
        own = Weights(*weights.value)
        node, root, first = (cell.column(n).to_numpy() for n in ("node", "root", "first"))
        found = [np.frombuffer(x, np.uint64) for x in cell.column("found").to_pylist()]
        links = cell_links(own, node, root, first, found)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    filled = cells.join(shingled, "node").groupBy("band", "key", "kind", "i", "j")
    return filled.applyInArrow(run, "a long, b long").distinct()


def cell_links(weights: Weights, node: np.ndarray, root: np.ndarray, first: np.ndarray, found: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of nodes in ``first`` with any node of another component, but no two that join the same ones.

    A shingle's k-th occurrence is an element of its own with the shingle's idf, so that the sum of the
    smaller weights is the summed idf of the elements two texts share; an inverted index gives it for
    one text and all others at once.
    """
    counts = [counted(x) for x in found]
    sizes = np.array([len(x) for x in found])
    value = np.concatenate(found) if len(found) else np.zeros(0, np.uint64)
    occurrence = np.concatenate([np.arange(len(x)) - np.repeat(np.cumsum(c) - c, c) for x, (_, c) in zip(found, counts)])
    idf = weights.of(value, np.ones(len(value), np.int64))
    _, element = np.unique(value + occurrence.astype(np.uint64) * _STEP, return_inverse=True)
    owner = np.repeat(np.arange(len(found)), sizes)
    total = np.bincount(owner, idf, len(found))
    begin = np.append(0, np.cumsum(sizes))
    sort = np.argsort(element, kind="stable")
    holder, edge = owner[sort], np.searchsorted(element[sort], np.arange(element.max(initial=-1) + 2))
    group: dict[int, int] = {}

    def top(x: int) -> int:
        while group.get(x, x) != x:
            x = group[x]
        return x

    links = []
    for row in np.flatnonzero(first):
        mine = slice(begin[row], begin[row + 1])
        start, size = edge[element[mine]], edge[element[mine] + 1] - edge[element[mine]]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        shared = np.bincount(holder[at], np.repeat(idf[mine], size), len(found))
        union = total + total[row] - shared
        for other in np.flatnonzero(shared >= SIMILARITY * union - 1e-9 * union):
            x, y = top(int(root[row])), top(int(root[other]))
            if x != y and shared[other] / union[other] >= SIMILARITY:
                group[max(x, y)] = min(x, y)
                links.append((int(node[row]), int(node[other])))
    return links



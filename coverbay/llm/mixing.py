"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source's rows are put in a random but fixed order (by the hash of the id), and their words laid on
a line, which is repeated up to ``MOST`` times; the mix takes the line's beginning, as long as the
source's target. The taken part is cut into blocks of equal length. The blocks of all sources are
divided among the output shards by a tree: each node splits the shards it stands for in two halves and
draws, without replacement, how many of each source's blocks go left. So each shard gets an exact
number of blocks, of each source about its share, and the numbers add up exactly. A shard then draws
its blocks from a permutation of the source's blocks, disjoint from all other shards', and shuffles
its rows by another hash: ``dealt`` gives each copy's shard and its place there, by prefix sums over
ranges of that hash, so a shard is no single task's work.

A row is taken as often as the middle of its words lies on the taken part, so each source misses its
target by half of one row at most. Sizes are words, runs of anything but space and U+0009 to U+000D.

Lines are laid by two levels of prefix sums (source and hash bucket, then the rows of a bucket), so a
hot source is spread over ``BUCKETS`` tasks. Sources are a named list of a mixture: up to
``MOST_SOURCES`` of them are fetched with their sizes, more raise ValueError.

NULL and empty texts have size 0. NULL is a source of its own, after all others. A source without
words has target 0. Rows with equal ids are rows of their own, each taken by its place on the line.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.llm.shared import fresh, materialise

WEIGHTS = (5, 2, 1)
MOST = 3
SHARDS = 8
BLOCKS = 1 << 20  # of all sources together, about
BUCKETS = 1024
MOST_SOURCES = 100_000
SEED = 6

_ORDER = ["key", "doc_id", "size", "tie"]
_SOURCE = ["nowhere", "origin"]


def words() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _columns(documents: DataFrame) -> list[Column]:
    """What a row's place depends on; ``tie`` tells equal rows apart."""
    return [
        F.col("source").isNull().alias("nowhere"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("origin"),
        F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id")), 1).alias("key"),  # 63 bits: never negative
        words().alias("size"),
        F.monotonically_increasing_id().alias("tie"),
    ]


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """Shares of all sizes by repeating weights, none above ``most`` times its size."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        whole = sum(weights[i % len(weights)] for i in open_)
        share = {i: left * weights[i % len(weights)] / whole for i in open_}
        above = [i for i in open_ if share[i] > most * sizes[i]]
        for i in above or open_:
            out[i] = float(most * sizes[i]) if above else share[i]
        left -= sum(out[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)] if above else []
    return out


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns)."""
    if shards == 1:
        return quotas[:, None]
    half = shards // 2
    left = rng.multivariate_hypergeometric(quotas, int(quotas.sum()) * half // shards, method="marginals") if len(quotas) else quotas
    return np.concatenate((split(left, half, rng), split(quotas - left, shards - half, rng)), axis=1)


def _sources(totals: DataFrame, shards: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: size, target, and how its blocks go to the shards."""
    spark = totals.sparkSession
    rows = totals.groupBy(*_SOURCE).agg(F.sum("words").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["nowhere"], r["origin"]))
    sizes = [r["size"] for r in rows]
    wanted = targets(sizes, weights, most)
    block = max(1, -(-sum(sizes) // BLOCKS))
    quotas = np.array([math.ceil(t / block) for t in wanted], np.int64)
    rng = np.random.default_rng(SEED)
    parts = np.cumsum(split(quotas, shards, rng), axis=1)
    out = []
    for row, size, target, quota, ends in zip(rows, sizes, wanted, quotas, parts):
        step = int(rng.integers(1, max(2, quota)))
        while math.gcd(step, int(quota)) != 1 and quota > 1:
            step = step % int(quota) + 1
        turn = int(rng.integers(0, max(1, quota)))
        out.append((row["nowhere"], row["origin"], size, target, block, int(quota), step, turn, [int(e) for e in ends]))
    schema = "nowhere boolean, origin string, source_size long, target double, block long, quota long, step long, turn long, ends array<long>"
    return spark.createDataFrame(out, schema)


def planned(documents: DataFrame, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row: doc_id, size, source_size, target, copies, and the shard of each copy.

    Also what orders the rows (nowhere, origin, key, tie).
    """
    lined = materialise(documents.select("doc_id", *_columns(documents)))
    bucket = F.shiftright("key", 63 - int(math.log2(BUCKETS))).alias("bucket")
    lined = lined.select("*", bucket)
    totals = lined.groupBy(*_SOURCE, "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*_SOURCE, "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*_SOURCE, "bucket").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lined.withColumn("upto", F.sum("size").over(inside)).join(offsets, [*_SOURCE, "bucket"])
    placed = placed.withColumn("start", F.col("before") + F.col("upto") - F.col("size"))
    placed = placed.join(_sources(totals, shards, weights, most), _SOURCE)
    turn = lambda n: F.lit(n) * F.col("source_size") + F.col("start")
    begins = F.filter(F.array(*(turn(n) for n in range(most))), lambda at: 2 * at + F.col("size") < 2 * F.col("target"))
    block = lambda at: F.least(F.floor(at / F.col("block")), F.col("quota") - 1)
    permuted = lambda at: F.pmod(block(at) * F.col("step") + F.col("turn"), F.col("quota"))
    shard = lambda at: F.size(F.filter("ends", lambda end: end <= permuted(at)))
    placed = placed.withColumn("shards", F.transform(begins, shard))
    return placed.select("doc_id", "size", "source_size", "target", F.size("shards").alias("copies"), "shards", *_SOURCE, "key", "tie")


def _placed(plan: DataFrame) -> DataFrame:
    """``plan`` with a row per copy: ``copy``, ``shard`` and ``position``, NULL where a row has none.

    Positions are counted in two levels, ranges of the hash that shuffles and the copies of a range.
    """
    place = F.shiftrightunsigned(F.xxhash64("key", "copy", F.lit(SEED)), 1)
    copies = plan.select("*", F.posexplode_outer("shards").alias("copy", "shard")).withColumn("place", place)
    copies = copies.withColumn("span", F.shiftright("place", 63 - int(math.log2(BUCKETS))))
    held = copies.where("shard is not null").groupBy("shard", "span").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "span").orderBy("place", "doc_id", "tie", "copy")
    copies = copies.withColumn("inside", F.row_number().over(inside)).join(starts, ["shard", "span"], "left")
    return copies.withColumn("position", F.col("first") + F.col("inside") - 1).drop("place", "span", "inside", "first")


def dealt(documents: DataFrame, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per row: doc_id, size, source_size, target, and the copies drawn of it, (copy, shard, position)."""
    plan = materialise(planned(documents, shards, weights, most))
    copy = F.when(F.col("shard").isNotNull(), F.struct("copy", "shard", "position"))
    rows = _placed(plan).groupBy("tie", "doc_id", "size", "source_size", "target").agg(F.array_sort(F.collect_list(copy)).alias("copies"))
    return rows.drop("tie")


def drawn(documents: DataFrame, shards: int = SHARDS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, shard, position): one row per copy; position counts a shard's rows from 0, shuffled."""
    copies = _placed(materialise(planned(documents, shards, weights, most)))
    return copies.where("shard is not null").select("doc_id", "shard", "position")


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents, with their own columns, each as often as the mix takes it.

    Rows of a source are taken in order, so two numbers say it all: how often every row is taken, and
    the last row that is taken once more. These are joined to the rows by source; texts aren't shuffled.
    """
    plan = materialise(planned(documents, 1, weights, most))
    least = plan.groupBy(*_SOURCE).agg(F.min("copies").alias("least"))
    last = F.max(F.when(F.col("copies") > F.col("least"), F.struct(*_ORDER))).alias("last")
    cuts = plan.join(F.broadcast(least), _SOURCE).groupBy(*_SOURCE, "least").agg(last)  # a row per source
    taken = documents.columns
    names = {n: fresh(taken, f"_{n}") for n in (*_SOURCE, "key", "size", "tie", "least", "last", "copy")}
    rows = documents.select("*", *(c.alias(names[n]) for n, c in zip((*_SOURCE, "key", "size", "tie"), _columns(documents))))
    cuts = cuts.select(*(F.col(n).alias(names[n]) for n in (*_SOURCE, "least", "last")))
    rows = rows.join(F.broadcast(cuts), [names[n] for n in _SOURCE])
    mine = F.struct(F.col(names["key"]), F.col("doc_id"), F.col(names["size"]), F.col(names["tie"]))
    more = F.coalesce(mine <= F.col(names["last"]), F.lit(False)).cast("int")
    copies = F.col(names["least"]) + more
    every = F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))
    return rows.select("*", F.explode(every).alias(names["copy"])).select(*taken)

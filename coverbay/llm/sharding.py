"""Contiguous shards of near equal bytes, by global prefix sums from per-partition totals.

The rows are put in the order of doc_id by a range partitioning. Each partition's bytes are summed;
the running sum of these few totals gives each partition the bytes before it, and a running sum inside
the partition gives each row its place on one line of all bytes. The line is cut into equal parts; a
row belongs to the part that holds its middle. A shard is thus a range of ids, and its bytes differ
from the target by one row at most. Only ids, sizes and checksums are shuffled, never texts.

A row's size is its text's UTF-8 bytes plus 1, for NULL 1. Rows without an id come first. Rows with
equal ids are ordered by checksum and size, then as they are stored; so a run of equal rows is cut
where the bytes demand it. Fewer rows than shards leave some shards empty; an empty table gives an
empty result. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.llm.shared import fresh, materialise

SHARDS = 8
_KEY = ["doc_id", "text_crc32", "size", "tie"]


def size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1


def _keys(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        size().alias("size"),
        F.monotonically_increasing_id().alias("tie"),
    )


def placed(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, text_crc32, size, tie, row, shard): row counts all rows from 0 in the order of the cut."""
    ranges = _keys(documents).repartitionByRange(*_KEY).withColumn("part", F.spark_partition_id())
    ranges = materialise(ranges)
    totals = ranges.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row per partition, so this window and the broadcast are bounded by the partitions' number
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*_KEY)
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lines = ranges.withColumn("upto", upto).withColumn("number", F.row_number().over(inside))
    lines = lines.join(F.broadcast(offsets), "part")
    middle = (2 * (F.col("bytes_before") + F.col("upto")) - F.col("size")).cast("decimal(38,0)")
    shard = F.floor(middle * F.lit(shards).cast("decimal(10,0)") / (2 * F.col("total")).cast("decimal(27,0)"))
    row = (F.col("rows_before") + F.col("number") - 1).cast("long")
    return lines.select(*_KEY, row.alias("row"), shard.cast("int").alias("shard"))


def numbered(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): slot counts a shard's rows from 0."""
    rows = materialise(placed(documents, shards))
    starts = rows.groupBy("shard").agg(F.min("row").alias("start"))  # one row per shard
    slotted = rows.join(F.broadcast(starts), "shard")
    return slotted.select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("start")).alias("slot"))


def assigned(documents: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, str]:
    """The documents with the column ``shard``, and the name it got.

    The first key of each shard is fetched, and every row is compared with these ``shards`` keys, so
    the texts stay where they are.
    """
    key = F.struct(*_KEY)
    firsts = placed(documents, shards).groupBy("shard").agg(F.min(key).alias("key")).orderBy("shard").collect()
    mine = F.struct(F.col("doc_id"), F.crc32(F.col("text").cast("binary")), size(), F.monotonically_increasing_id())
    name = fresh(documents.columns, "shard")
    shard = F.lit(firsts[0]["shard"] if firsts else None).cast("int")
    kinds = ["bigint", "bigint", "bigint", "bigint"]
    for first in firsts[1:]:
        cut = F.struct(*(F.lit(value).cast(kind) for value, kind in zip(first["key"], kinds)))
        shard = F.when(mine >= cut, F.lit(first["shard"])).otherwise(shard)
    return documents.withColumn(name, shard), name

"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import coverbay.llm

# Tasks carry this subpackage's code with them, so executors need no copy of it. Broadcasts don't:
# they hold plain values and arrays only.
cloudpickle.register_pickle_by_value(coverbay.llm)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors and the driver share: the session's, else one for this run.

    A session that names ``spark.checkpoint.dir`` keeps it. Only where it is unset, as in tests on
    one machine, a temporary folder is made and noted in the session; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, with its lineage cut."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again, so that Spark knows its size.

    A join then broadcasts it if it is below the session's threshold, and shuffles both sides if not.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_numbers(df: DataFrame, keys: list[str], name: str = "row") -> DataFrame:
    """``df`` with the place of each row, from 0, in the ascending order of ``keys``, NULL first.

    Rows are put in ranges of the keys and counted per range; running sums of these counts, one per
    partition, and a row number inside each range give the place. Equal rows are cut apart where a
    range would grow too large; they are numbered in the order in which they are stored.
    """
    tie = fresh(df.columns, "tie")
    part = fresh([*df.columns, tie], "part")
    ranges = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys, tie)
    ranges = materialise(ranges.withColumn(part, F.spark_partition_id()))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = ranges.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*keys, tie))
    numbered = ranges.withColumn(name, inside.cast("long")).join(F.broadcast(starts), part)
    return numbered.select(*df.columns, (F.col(name) + F.col("start") - 1).alias(name))


def fresh(taken: list[str], name: str) -> str:
    """``name``, or a longer one that no column has, whatever its case."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def remainder(id_column: Column, modulus: int) -> Column:
    """CRC-32 of an id written as text, modulo ``modulus``; NULL for a missing id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def bounded_examples(documents: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> DataFrame:
    """(tie, text, target): one row per labelled document, ``most`` rows at most.

    Chosen by the hash of the id, so the same rows on every run. ``learn`` says which ids may be
    learned from. An id with several labels takes the largest; an id with several texts the smallest.
    Rows without id or label are never chosen. The chosen ids (``most`` rows of two numbers) are
    broadcast.
    """
    chosen = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("target").alias("target"))
        .select(F.xxhash64("doc_id").alias("tie"), "text", "target")
    )

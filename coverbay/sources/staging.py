"""Tables computed once and kept in the shared folder while a query of several jobs runs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from coverbay.sources import folders

Stage = Callable[[DataFrame], DataFrame]

#: With it the shuffle files of a job go as soon as it ends, not when the driver happens to collect its garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors and the driver share: the session's, else one for this run on one machine.

    None on a cluster that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = f"file://{tempfile.gettempdir()}/run-{spark.sparkContext.applicationId}"
    return folder.rstrip("/") if folder else None


def stored(df: DataFrame, folder: str | None) -> DataFrame:
    """``df`` written once and read again; as it is where there is no shared folder."""
    if not folder:
        return df
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Stage]:
    """A function that stages tables until the end of the block, whose jobs leave no shuffle files.

    What is made of staged tables must be complete before the block ends.
    """
    shared = shared_folder(spark)
    folder = f"{shared}/staged-{uuid.uuid4().hex}" if shared else None
    before = spark.conf.get(FILE_CLEANUP, None)
    # without a folder plans are handed out unfinished, and nothing is freed below them
    if folder:
        spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield lambda df: stored(df, folder)
    finally:
        if folder:
            if before is None:
                spark.conf.unset(FILE_CLEANUP)
            else:
                spark.conf.set(FILE_CLEANUP, before)
            folders.delete(spark, folder)


def result(df: DataFrame) -> DataFrame:
    """A query's result, complete: small, and kept when the staged tables go."""
    return stored(df, shared_folder(df.sparkSession))

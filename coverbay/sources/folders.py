"""Folders of the file system behind a path, through Spark's own file system layer."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Only one of several callers succeeds."""
    hadoop, files = _path(spark, path)
    try:
        files.create(hadoop, False).close()
    except Py4JJavaError as error:
        if files.exists(hadoop):
            return False
        raise error
    return True


def touch(spark: SparkSession, path: str) -> None:
    """Write an empty file, new or again."""
    hadoop, files = _path(spark, path)
    files.create(hadoop, True).close()


def modified(spark: SparkSession, path: str) -> int | None:
    """When a file was last written, in milliseconds of the file system's clock; None if it is not there."""
    hadoop, files = _path(spark, path)
    return files.getFileStatus(hadoop).getModificationTime() if files.exists(hadoop) else None


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds; nothing happens if it is not there."""
    hadoop, files = _path(spark, path)
    files.delete(hadoop, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if it is not there."""
    hadoop, files = _path(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(hadoop)) if files.exists(hadoop) else []

"""Readers and writers for the raw and star tables kept as delimited files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coverbay.schemas import RAW, RAW_OPTIONAL, STAR

CORRUPT = "_corrupt_record"


class MissingTable(Exception):
    """A table that should exist is not there."""


class EmptyTable(Exception):
    """A table that must have rows has none."""


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("nullValue", "").option("enforceSchema", False)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.csv"


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a delimited file; reads its first line only."""
    try:
        return _csv(spark).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(path) from error
        raise


def aligned_schema(columns: list[str], *known: StructType) -> StructType:
    """The file's own column order with the types we know; extra columns stay text."""
    types = {field.name: field.dataType for schema in known for field in schema}
    return StructType([StructField(name, types.get(name, StringType())) for name in columns])


def _read(spark: SparkSession, root: str, name: str, known: list[StructType], mode: str) -> DataFrame:
    path = table_path(root, name)
    schema = aligned_schema(header(spark, path), *known)
    reader = _csv(spark).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = schema.add(CORRUPT, StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def _known(name: str) -> list[StructType]:
    return [RAW[name], RAW_OPTIONAL.get(name, StructType())]


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One raw table with strict types: a value that does not parse fails the job."""
    df = _read(spark, root, name, _known(name), "FAILFAST")
    if df.isEmpty():
        raise EmptyTable(name)
    return df


def read_raw_for_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One raw table for a quality report: bad values become NULL, their line is kept beside them."""
    return _read(spark, root, name, _known(name), "PERMISSIVE")


def read_star_csv(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One normalised table with strict types, in its load order."""
    df = _read(spark, root, name, [STAR[name]], "FAILFAST")
    if df.isEmpty():
        raise EmptyTable(name)
    return df.select(STAR[name].names)


def read_all_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    missing = missing_files(spark, root, list(RAW))
    if missing:
        raise MissingTable(", ".join(missing))
    return {name: read_raw(spark, root, name) for name in RAW}


def missing_files(spark: SparkSession, root: str, expected: list[str]) -> list[str]:
    """Expected tables that have no file under ``root``."""
    missing = []
    for name in expected:
        try:
            header(spark, table_path(root, name))
        except MissingTable:
            missing.append(name)
    return missing


def write_csv(df: DataFrame, root: str, name: str) -> None:
    """Header, no index, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(table_path(root, name))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name, row_count``."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result

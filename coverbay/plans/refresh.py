"""From raw files to a published warehouse version, with a gate after each stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from coverbay.operators import quality
from coverbay.operators.star import build_star
from coverbay.schemas import RAW
from coverbay.sources import folders
from coverbay.sources.raw import CORRUPT, missing_files, read_raw_for_report
from coverbay.sources.warehouse import KEPT_VERSIONS, claim_version, load_warehouse, release_version, table_path


def staging_folder(spark: SparkSession, warehouse_root: str) -> str:
    """A new folder in the shared place the cluster names, else beside the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse_root}/staging"
    return f"{shared.rstrip('/')}/raw-{uuid.uuid4().hex}"


def stage_raw(spark: SparkSession, raw: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The raw tables as Parquet: text is parsed once, later jobs read only the columns they need."""
    staged = {}
    for name, table in raw.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
        staged[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
    return staged


def refresh_warehouse(
    spark: SparkSession,
    raw_root: str,
    warehouse_root: str,
    bounds: quality.Bounds = quality.Bounds(),
    keep: int = KEPT_VERSIONS,
) -> int:
    """Read, check, shape, load and check again; returns the published version.

    The raw report is stored with the version, whether the gate opens or not: missing files, empty
    tables and lines that don't parse are rules in it like any other. The staged copy of the raw
    tables is removed in the end.
    """
    missing = missing_files(spark, raw_root, list(RAW))
    raw = {name: read_raw_for_report(spark, raw_root, name) for name in RAW if name not in missing}
    folder = staging_folder(spark, warehouse_root)
    version = claim_version(spark, warehouse_root)
    try:
        staged = stage_raw(spark, raw, folder)
        path = table_path(warehouse_root, version, "raw_report")
        quality.check_raw(spark, staged, bounds).coalesce(1).write.mode("overwrite").parquet(path)
        quality.enforce(spark.read.parquet(path))
        star = build_star({name: table.drop(CORRUPT) for name, table in staged.items()})
        return load_warehouse(spark, star, warehouse_root, version, keep)
    except BaseException:
        release_version(spark, warehouse_root, version)
        raise
    finally:
        folders.delete(spark, folder)

"""Staged tables live as long as their block, and shuffle files no longer than their job."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from coverbay.sources import staging


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: f"file://{tmp_path}")
    return tmp_path


def test_staged_tables_go_and_results_stay(spark, folder):
    before = spark.conf.get(staging.FILE_CLEANUP, None)
    with staging.staging(spark) as stage:
        table = stage(spark.range(10).groupBy((F.col("id") % 3).alias("k")).agg(F.sum("id").alias("total")))
        assert len(list(folder.glob("staged-*/table-*/*.parquet"))) > 0
        assert spark.conf.get(staging.FILE_CLEANUP) == "true"
        kept = staging.result(table.where("k < 2"))
    assert not list(folder.glob("staged-*"))
    assert spark.conf.get(staging.FILE_CLEANUP, None) == before
    assert sorted(map(tuple, kept.collect())) == [(0, 18), (1, 12)]


def test_the_setting_is_restored_after_an_error(spark, folder):
    before = spark.conf.get(staging.FILE_CLEANUP, None)
    with pytest.raises(ValueError), staging.staging(spark) as stage:
        stage(spark.range(3))
        raise ValueError
    assert spark.conf.get(staging.FILE_CLEANUP, None) == before and not list(folder.glob("staged-*"))


def test_a_cluster_without_a_shared_folder_stages_nothing(spark):
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    table = spark.range(3)
    with staging.staging(cluster) as stage:
        assert stage(table) is table
    assert staging.shared_folder(cluster) is None
    cluster.sparkContext = SimpleNamespace(master="local[2]", applicationId="local-1")
    assert staging.shared_folder(cluster).endswith("/run-local-1")

"""Queries of many jobs stage the raw tables once, return complete rows and leave no staged tables."""

from __future__ import annotations

import datetime
import random

import pytest

from coverbay.operators import quality
from coverbay.plans import catalogue, views
from coverbay.sources import staging
from tests.tables import row_set

STAGED = ["claims_loss_repeated_ids", "claims_by_year_repeated_ids", "quality_dirty", "quality_loaded"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Source tables with orders without lines, lines without an order, NULL keys and a repeated order."""
    rng, folder = random.Random(3), str(tmp_path_factory.mktemp("tables"))

    def day():
        return datetime.datetime(1995, 1, 1) + datetime.timedelta(days=rng.randrange(2300))

    orders = [(rng.choice([i, i, i + 10_000, 7]), rng.choice([None, *range(14)]), rng.choice("OFP"), day()) for i in range(90)]
    lines = [
        (rng.choice([None, *range(95)]), rng.randrange(500), rng.randrange(5), 1 + i % 7, round(rng.uniform(900, 90_000), 2), rng.randrange(11) / 100, day())
        for i in range(300)
    ]
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", i % 2) for i in range(4)]),
        "customer": ("c_custkey bigint, c_nationkey int, c_acctbal double", [(i, i % 4, i * 321.5) for i in range(12)]),
        "supplier": ("s_suppkey bigint, s_nationkey int", [(i, i % 4) for i in range(5)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp", orders),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_discount double, l_shipdate timestamp",
            [*lines, lines[3]],
        ),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", STAGED)
def test_staged_queries_return_the_same_complete_rows(spark, tables, name, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: None)
    expected = row_set(catalogue.query(name)(spark, tables))
    monkeypatch.setattr(staging, "shared_folder", lambda spark: f"file://{tmp_path}")
    found = catalogue.query(name)(spark, tables)
    assert not list(tmp_path.glob("staged-*"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "Exchange" not in plan
    assert row_set(found) == expected and len(expected) > 2


@pytest.mark.parametrize(
    "name, module, check",
    [
        ("claims_by_year_repeated_ids", views, "claims_over"),
        ("quality_dirty", quality, "check_tables"),
        ("quality_loaded", views, "build_views"),
    ],
)
def test_jobs_read_staged_tables_instead_of_joining_again(spark, tables, name, module, check, monkeypatch, tmp_path):
    seen, whole = [], getattr(module, check)

    def noted(*args, **kwargs):
        star = next(arg for arg in args if isinstance(arg, dict))
        seen.append(star["fact_claims"]._jdf.queryExecution().optimizedPlan().toString() + str(star["fact_claims"].inputFiles()))
        return whole(*args, **kwargs)

    monkeypatch.setattr(staging, "shared_folder", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(module, check, noted)
    catalogue.query(name)(spark, tables)
    assert len(seen) == 1 and "/staged-" in seen[0] and "lineitem" not in seen[0]

"""The driver contract, and a query of each family against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check_oracles import compare
from coverbay import standin
from coverbay.plans.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    registered, with_sql = set(spark_entry.queries()), set(spark_entry.oracle_sql())
    assert set(QUERIES) <= with_sql <= registered
    # the optional queries, where their files are there
    assert all(name == "pipeline" or name.startswith("op") for name in registered - set(QUERIES))


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[:5] == ["month_date", "year", "month", "year_month", "active_policies"]
    assert df.count() > 0


@pytest.mark.parametrize(
    "name",
    [
        "dim_time", "dim_clients", "fact_policies", "fact_claims", "fact_expenses", "fact_taxes",
        "exec_portfolio", "claims_loss", "slice_year", "kpi_yoy", "top_states_by_premium",
        "claims_dashboard_rollup", "risk_dashboard", "quality_raw", "quality_star", "quality_ddl",
        "remaining_capacity", "capacity_shortfall", "capacity_pool", "expected_claims", "actual_vs_expected_claims",
        "premium_exposure_by_month_lob", "claims_loss_true_exposure", "expense_grid", "portfolio_targets",
    ],
)
def test_query_equals_its_oracle(spark, con, name):
    good, note = compare(spark, con, name, SF_DIR)
    assert good, note


def test_stand_in_tables(spark):
    raw = standin.raw_tables(spark, SF_DIR)
    counts = {name: table.count() for name, table in raw.items()}
    assert counts == {"clients": 150, "policies": 1500, "claims": 6000, "expenses": 799, "taxes": 1500}

"""Shapes of the physical plans that make the queries scale."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from coverbay.operators import quality, skew, star as builders
from coverbay.operators.inforce import Calendar
from coverbay.plans import dashboards, views
from coverbay.sources import warehouse
from tests.tables import random_star_rows, row_set, spark_star

D = datetime.date


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    tables = {}
    for name, table in spark_star(spark, random_star_rows(7)).items():
        warehouse.write_table(table, f"{root}/{name}", name)
        tables[name] = spark.read.schema(table.schema).parquet(f"{root}/{name}").select(table.columns)
    return tables


def test_no_view_joins_policies_to_days(stored):
    for name, view in views.build_views(stored).items():
        text = plan(view)
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name
        assert "Python" not in text and "Scan ExistingRDD" not in text, name
        assert "dim_time" not in text, name
        assert text.count("/fact_policies]") == 1, name


def test_only_needed_columns_and_rows_are_read(stored):
    text = plan(views.operations_daily(stored, Calendar(D(2024, 2, 1), D(2024, 2, 10))))
    scan = next(line for line in text.splitlines() if "/fact_policies]" in line)
    assert "annual_premium" not in scan and "risk_score" not in scan and "status" not in scan
    assert "LessThanOrEqual(effective_date_key,20240210)" in scan.replace(" ", "")
    assert "policy_year" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_slices_reach_the_scan(stored):
    view = views.exec_portfolio(stored)
    sliced = dashboards.slice_view(view, state_code="NY", region_code="NE")
    scan = next(line for line in plan(sliced).splitlines() if "/fact_policies]" in line)
    assert "NY" in scan or "state_code" in scan.split("PushedFilters")[0].split("DataFilters")[1]
    assert row_set(sliced) == row_set(view.where("state_code = 'NY' AND region_code = 'NE'"))


def test_slices_add_up_to_the_whole(stored):
    view = views.operations_daily(stored)
    lines = [r[0] for r in view.select("line_of_business").distinct().collect()]
    parts = [row for line in lines if line is not None for row in row_set(dashboards.slice_view(view, line_of_business=line))]
    parts += row_set(view.where("line_of_business IS NULL"))
    assert sorted(map(str, parts)) == sorted(map(str, row_set(view)))
    assert row_set(dashboards.slice_view(view, year=2024)) == row_set(view)


def test_invariants_between_views(stored):
    operations, risk = views.operations_daily(stored), views.risk_daily(stored)
    calendar = Calendar.of(stored["dim_time"])
    starts = stored["fact_policies"].where(F.col("effective_date_key").between(*calendar.key_range()))
    valid = starts.where("expiration_date_key IS NULL OR expiration_date_key >= effective_date_key")
    assert operations.agg(F.sum("policies_started")).first()[0] == valid.count()
    mix = risk.where("new_business_policies + renewal_policies > active_policies")
    assert mix.isEmpty()
    portfolio = views.exec_portfolio(stored)
    # annual premiums are twelve times the monthly ones, to the cent, in the random tables
    off = portfolio.where("total_annual_premium IS DISTINCT FROM total_monthly_premium * 12")
    assert off.isEmpty()


def claims_and_policies(spark, n=3000):
    rng = random.Random(3)
    keys = ["P1"] * (n // 3) + [None] * (n // 3) + [f"P{rng.randrange(50)}" for _ in range(n // 3)]
    left = spark.createDataFrame([(k, f"K{i}") for i, k in enumerate(keys)], "k string, id string")
    right = spark.createDataFrame([(f"P{i}", i) for i in range(40)] + [("P1", -1), (None, -2)], "k string, v int")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    left, right = claims_and_policies(spark)
    salted = skew.salted_join(left, right, "k", "id", how, rows_per_slice=100)
    assert row_set(salted, "k", "id", "v") == row_set(left.join(right, "k", how), "k", "id", "v")
    # nothing is hot: same rows
    plain = skew.salted_join(left, right, "k", "id", how)
    assert row_set(plain, "k", "id", "v") == row_set(left.join(right, "k", how), "k", "id", "v")


def test_hot_keys_are_cut_into_slices(spark):
    left, _ = claims_and_policies(spark)
    hot = {row.hot_key: row.slices for row in skew.hot_keys(left, "k", rows_per_slice=100).collect()}
    assert set(hot) == {None, "P1"} and hot[None] == 10 and hot["P1"] in (10, 11)
    # no more keys than rows / rows_per_slice can be hot, which bounds the broadcast list
    assert skew.hot_keys(left, "k", rows_per_slice=10).count() <= left.count() / 10
    assert skew.hot_keys(left, "k").isEmpty()


def test_a_hot_policy_is_spread_over_tasks(spark):
    left, right = claims_and_policies(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        def largest(df):
            sizes = df.where("k = 'P1' OR k IS NULL").groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        plain = left.join(right.where("v >= 0"), "k", "left")
        salted = skew.salted_join(left, right.where("v >= 0"), "k", "id", rows_per_slice=100)
        assert largest(plain) >= 1000
        assert largest(salted) <= 500
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_fact_claims_join_is_salted(spark, stored):
    claims = stored["fact_claims"].selectExpr(
        "claim_id", "policy_id", "DATE'2024-01-01' AS incident_date", "DATE'2024-01-01' AS report_date", "claim_type",
        "claim_amount_requested", "claim_amount_approved", "claim_amount_paid", "claim_status",
    )
    policies = stored["fact_policies"].selectExpr("policy_id", "state_code", "region_code", "'Auto' AS line_of_business", "'Full' AS plan_name")
    assert "salt" in plan(builders.build_fact_claims(claims, policies))


def test_keys_that_are_numbers_stay_numbers(spark, stored):
    rules = [rule for rule in quality.star_rules() if quality._runnable(rule, stored)]
    text = plan(quality._key_results(rules, stored)[0])
    keys = [line for line in text.splitlines() if "Generate inline" in line and "date_key" in line]
    assert keys and not any(f"cast({name}" in line and "as string" in line.split(f"cast({name}")[1][:60] for line in keys for name in ("date_key", "incident_date_key"))
    assert all("as bigint" in line for line in keys)


def test_shares_read_no_table_again(spark, stored):
    kinds = (quality.Share, quality.NotEmpty)
    rules = [rule for rule in quality.star_rules() if isinstance(rule, kinds) and quality._runnable(rule, stored)]
    text = plan(quality._row_results(rules, stored)[0])
    assert text.count("/fact_claims]") == text.count("/fact_policies]") == 1


def test_keeping_one_row_per_key_sorts_repeated_keys_only(spark, stored):
    table = stored["dim_policies"]
    text = plan(builders.first_per_key(table, "policy_id", table.columns))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("SortAggregate") <= 2 and "Window" not in text

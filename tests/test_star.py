from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverbay.operators import star as builders
from coverbay.schemas import STAR
from tests.tables import money, raw_table, row_set

D = datetime.date


def policy(id_, start, end, line="Auto", plan="Full", number="N1", renewal=False):
    return (
        id_, number, "C1", line, plan, "NY", "NE", start, end, "Active", renewal,
        money(5), money(10), money(120),
    )


def claim(id_, policy_id, day, report=None):
    return (id_, policy_id, day, report or day, "Theft", money(10), money(9), money(9), "Paid")


def test_dim_time_spans_policies_and_claims(spark):
    policies = raw_table(spark, "policies", [policy("P1", D(2024, 2, 27), None)])
    claims = raw_table(spark, "claims", [claim("K1", "P1", D(2024, 2, 28), D(2024, 3, 3))])
    rows = builders.build_dim_time(policies, claims).orderBy("date_key").collect()
    assert [r.date_key for r in rows] == [20240227, 20240228, 20240229, 20240301, 20240302, 20240303]
    leap, saturday, sunday = rows[2], rows[4], rows[5]
    assert (leap.month_name, leap.quarter, leap.year_month, leap.day_of_week) == ("February", 1, "2024-02", 4)
    assert (saturday.day_of_week, saturday.is_weekend) == (6, True)
    assert (sunday.day_of_week, sunday.is_weekend) == (7, True)


def test_dim_time_ignores_text_that_is_no_date(spark):
    policies = spark.createDataFrame(
        [("2023-12-30", "2024-01-01"), ("never", "2024-13-01")], "effective_date string, expiration_date string"
    )
    claims = spark.createDataFrame([("2023-12-31", "?")], "incident_date string, report_date string")
    rows = builders.build_dim_time(policies, claims).orderBy("date_key").collect()
    assert [(r.date_key, r.year, r.quarter) for r in rows] == [
        (20231230, 2023, 4), (20231231, 2023, 4), (20240101, 2024, 1),
    ]


def test_dim_state_keeps_a_state_with_two_tiers(spark):
    clients = raw_table(
        spark,
        "clients",
        [
            ("C1", 2024, 30, "Male", "NY", "NE", "Tier 1", "Individual", 1),
            ("C2", 2024, 30, "Male", "NY", "NE", "Tier 2", "Individual", 1),
            ("C3", 2024, 30, "Male", "NY", "NE", "Tier 1", "Individual", 1),
        ],
    )
    assert row_set(builders.build_dim_state(clients)) == [("NY", "NE", "Tier 1"), ("NY", "NE", "Tier 2")]


def test_repeated_ids_keep_one_whole_row(spark):
    clients = raw_table(
        spark,
        "clients",
        [
            ("C1", 2025, 20, "Male", "NY", "NE", "Tier 1", "Individual", 1),
            ("C1", 2024, 60, "Male", "CA", "W", "Tier 2", "Corporate", 3),
            ("C1", 2024, None, "Female", "TX", "W", "Tier 2", "Corporate", 2),
        ],
    )
    built = builders.build_dim_clients(clients)
    assert built.columns == STAR["dim_clients"].names
    # smallest by the other columns, NULL first
    assert row_set(built) == [("C1", 2024, None, "Female", "Corporate", "TX", "W", "Tier 2", 2)]

    policies = raw_table(
        spark,
        "policies",
        [policy("P1", D(2024, 1, 1), None, number="N2"), policy("P1", D(2024, 1, 1), None, number="N1", renewal=True)],
    )
    assert row_set(builders.build_dim_policies(policies)) == [("P1", "N1", "C1", "NY", "NE", True)]
    assert builders.build_fact_policies(policies).count() == 2


def test_products(spark):
    policies = raw_table(
        spark,
        "policies",
        [
            policy("P1", D(2024, 1, 1), None, plan="Full cover"),
            policy("P2", D(2024, 1, 1), None, plan="Full cover"),
            policy("P3", D(2024, 1, 1), None, plan=None),
        ],
    )
    assert row_set(builders.build_dim_products(policies)) == [
        (None, "Auto", None), ("AUTO_FULL_COVER", "Auto", "Full cover"),
    ]


def test_fact_policies(spark):
    policies = raw_table(spark, "policies", [policy("P1", D(2024, 2, 29), D(2025, 2, 27)), policy("P2", D(2024, 1, 1), None)])
    built = builders.build_fact_policies(policies)
    assert built.schema.names == STAR["fact_policies"].names
    assert [f.dataType for f in built.schema] == [f.dataType for f in STAR["fact_policies"]]
    assert row_set(built, "policy_id", "effective_date_key", "expiration_date_key", "policy_year", "policy_month") == [
        ("P1", 20240229, 20250227, 2024, 2), ("P2", 20240101, None, 2024, 1),
    ]
    bad = policies.withColumn("effective_date", F.lit("29.02.2024"))
    with pytest.raises(Exception, match="29.02.2024|PARSE"):
        builders.build_fact_policies(bad).collect()


def test_fact_claims(spark):
    policies = raw_table(spark, "policies", [policy("P1", D(2024, 1, 1), None)])
    claims = raw_table(
        spark, "claims",
        [claim("K1", "P1", D(2024, 1, 2)), claim("K2", "P9", D(2024, 1, 3)), claim("K3", None, D(2024, 1, 3))],
    )
    built = builders.build_fact_claims(claims, policies)
    assert [f.dataType for f in built.schema] == [f.dataType for f in STAR["fact_claims"]]
    columns = ("claim_id", "product_key", "line_of_business", "state_code", "fraud_flag", "incident_date_key", "settlement_date_key")
    assert row_set(built, *columns) == [
        ("K1", "AUTO_FULL", "Auto", "NY", False, 20240102, None),
        ("K2", None, None, None, False, 20240103, None),
        ("K3", None, None, None, False, 20240103, None),
    ]
    flagged = raw_table(spark, "claims", [claim("K1", "P1", D(2024, 1, 2)) + ("Yes",)], optional=True)
    assert builders.build_fact_claims(flagged, policies).first().fraud_flag is True


def test_fact_claims_fans_out_on_a_repeated_policy(spark):
    policies = raw_table(spark, "policies", [policy("P1", D(2024, 1, 1), None), policy("P1", D(2024, 1, 1), None, plan="Basic")])
    claims = raw_table(spark, "claims", [claim("K1", "P1", D(2024, 1, 2))])
    assert row_set(builders.build_fact_claims(claims, policies), "product_key") == [("AUTO_BASIC",), ("AUTO_FULL",)]


def test_fact_expenses_and_taxes(spark):
    expenses = raw_table(spark, "expenses", [(7, "Operating", "NY", "NE", D(2024, 2, 17), money(5))])
    assert row_set(builders.build_fact_expenses(expenses)) == [("7", "Operating", "NY", "NE", 20240201, Decimal("5.00"))]

    taxes = raw_table(spark, "taxes", [(1, "P1", "NY", money(3.5), money(0.035)), (2, "P1", "NY", money(0), money(0)), (3, "P1", "NY", money(1), money(0))])
    assert row_set(builders.build_fact_taxes(taxes), "tax_id", "tax_type", "date_key", "tax_base") == [
        ("1", "PREMIUM_TAX", None, Decimal("100.000000")), ("2", "PREMIUM_TAX", None, None), ("3", "PREMIUM_TAX", None, None),
    ]
    given = raw_table(spark, "taxes", [(1, "P1", "NY", money(3.5), money(0), money(77))], optional=True)
    assert builders.build_fact_taxes(given).first().tax_base == Decimal("77.000000")

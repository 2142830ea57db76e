from __future__ import annotations

import datetime
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverbay.operators import derive
from coverbay.sources.parameters import NEW_BUSINESS_WEIGHTS, default_parameters
from tests.tables import row_set

D = datetime.date


def values(df):
    return [row[0] for row in df.collect()]


def test_policy_end_renewal_and_report_date(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 2024), (D(2025, 6, 1), 2024)], "effective date, registered int")
    end = F.lit(D(2025, 12, 31))
    assert values(df.select(derive.policy_end(F.col("effective"), end))) == [D(2024, 12, 30), D(2025, 12, 31)]
    assert values(df.select(derive.is_renewal(F.col("registered"), F.year("effective")))) == [False, True]
    assert values(df.select(derive.report_date(F.col("effective"), F.lit(300), end))) == [D(2024, 10, 27), D(2025, 12, 31)]


@pytest.mark.parametrize("segment", ["Individual", "Corporate"])
def test_base_score_by_age(spark, segment):
    loadings = {25: "1.5", 26: "0.5", 35: "0.5", 36: "0", 50: "0", 51: "1.0", 65: "1.0", 66: "2.5"}
    df = spark.createDataFrame([(age,) for age in loadings], "age int")
    discount = Decimal("0.3") if segment == "Corporate" else Decimal(0)
    scores = values(df.select(derive.base_risk_score(F.col("age"), F.lit(segment))))
    assert scores == [5 + Decimal(add) - discount for add in loadings.values()]


def test_risk_score_is_rounded_and_clipped(spark):
    def score(deviation):
        return derive.risk_score(F.lit(40), F.lit("Individual"), F.lit(deviation).cast("decimal(18,4)"))

    row = spark.range(1).select(score("0.125"), score("0.135"), score("9"), score("-9"), score(None)).first()
    assert tuple(row) == (Decimal("5.12"), Decimal("5.14"), Decimal("10.00"), Decimal("1.00"), None)


def test_capacity_grows_after_registration(spark):
    df = spark.createDataFrame([(y,) for y in range(2023, 2029)], "year int")
    grown = derive.client_capacity(F.lit(2024), F.lit(2), F.col("year"))
    assert values(df.select(grown)) == [2, 2, 3, 4, 4, 4]


def capacity_tables(spark):
    clients = spark.createDataFrame(
        [("C1", 2024, 1), ("C2", 2025, 2)], "client_id string, registration_year int, max_policies_allowed int"
    )
    policies = spark.createDataFrame(
        [("C1", D(2023, 5, 1)), ("C1", D(2024, 5, 1)), ("C1", D(2024, 6, 1)), ("C2", D(2025, 1, 1)), ("C9", D(2024, 1, 1))],
        "client_id string, effective_date date",
    )
    return clients, policies


def test_remaining_capacity_counts_all_earlier_policies(spark):
    left = derive.remaining_capacity(*capacity_tables(spark), 2026)
    assert row_set(left, "client_id", "year", "capacity", "held", "remaining") == [
        ("C1", 2024, 1, 1, 0), ("C1", 2025, 2, 3, -1), ("C1", 2026, 3, 3, 0), ("C2", 2025, 2, 0, 2), ("C2", 2026, 3, 1, 2),
    ]


def test_shortfall_and_pool(spark):
    clients, policies = capacity_tables(spark)
    rows = derive.capacity_shortfall(clients, policies, 2025)
    columns = ("year", "eligible_clients", "remaining_capacity", "new_policies", "shortfall", "relax_rounds", "capacity_failure")
    assert row_set(rows, *columns) == [
        (2023, 0, 0, 1, True, None, True), (2024, 1, 0, 3, True, 3, False), (2025, 2, 1, 1, False, 0, False),
    ]
    more = policies.unionByName(spark.createDataFrame([("C9", D(2024, 1, 1))], policies.schema))
    assert row_set(derive.capacity_shortfall(clients, more, 2024).where("year = 2024"), "relax_rounds", "capacity_failure") == [(4, True)]
    assert row_set(derive.capacity_pool(clients, policies, 2025)) == [("C2", 1), ("C2", 2)]
    # three rounds raise the one eligible client from none left to three
    assert row_set(derive.capacity_pool(clients, policies, 2024)) == [("C1", 1), ("C1", 2), ("C1", 3)]


def test_shortfall_keeps_years_without_clients(spark):
    clients, policies = capacity_tables(spark)
    more = policies.unionByName(spark.createDataFrame([("C9", D(1990, 1, 1)), ("C9", None)], policies.schema))
    rows = derive.capacity_shortfall(clients, more, 2025).where("year is null or year < 2000")
    columns = ("year", "eligible_clients", "new_policies", "shortfall", "relax_rounds", "capacity_failure")
    assert sorted(row_set(rows, *columns), key=str) == [(1990, 0, 1, True, None, True), (None, 0, 1, True, None, True)]


def test_missing_dates_stay_missing(spark):
    df = spark.createDataFrame([(None, 3), (D(2024, 1, 1), None)], "day date, delay int")
    end = F.lit(D(2024, 6, 1))
    assert df.select(derive.policy_end(F.col("day"), end)).collect() == [(None,), (D(2024, 6, 1),)]
    assert df.select(derive.report_date(F.col("day"), F.col("delay"), end)).collect() == [(None,), (None,)]


def test_exposure_counts_both_ends(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 1), D(2024, 12, 30)), (D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 2), D(2024, 1, 1)), (D(2024, 1, 1), None)],
        "effective_date date, expiration_date date",
    )
    exposed = derive.exposure(df, F.lit(D(2024, 1, 10)))
    assert row_set(exposed, "exposure_days", "year_fraction") == [(1, 1 / 365), (10, 10 / 365), (365, 1.0)]


def window_end():
    return F.lit("2025-12-31").cast("date")


def claim_policies(spark):
    return spark.createDataFrame(
        [("P1", "Health", "FL", D(2024, 7, 1), D(2025, 6, 30)), ("P2", "Auto", "ZZ", D(2024, 1, 1), D(2024, 1, 10))],
        "policy_id string, line_of_business string, state_code string, effective_date date, expiration_date date",
    )


def test_expected_claims(spark):
    parameters = default_parameters(spark)
    rows = row_set(derive.expected_claims(claim_policies(spark), parameters, window_end()), "policy_id", "expected_claims")
    assert rows[0] == ("P1", pytest.approx(0.25 * 1.14 * 1.18))
    assert rows[1] == ("P2", pytest.approx(0.10 * 0.90 * 1.0 * 10 / 365))
    negative = replace(parameters, climate=parameters.climate.withColumn("climate", -F.col("climate")))
    assert ("P1", 0.0) in row_set(derive.expected_claims(claim_policies(spark), negative, window_end()), "policy_id", "expected_claims")


def test_actual_against_expected(spark):
    claims = spark.createDataFrame([("P1",)] * 3 + [("P9",), (None,)], "policy_id string")
    rows = row_set(derive.actual_vs_expected(claim_policies(spark), claims, default_parameters(spark), window_end()))
    assert [row[:5] for row in rows] == [("Auto", "ZZ", 1, 0, 0), ("Health", "FL", 1, 0, 3)]
    assert rows[1][6] == pytest.approx(3 / (0.25 * 1.14 * 1.18))


def test_actual_and_expected_cover_the_same_policies(spark):
    policies = claim_policies(spark).unionByName(
        spark.createDataFrame(
            [
                ("P3", "Auto", "TX", D(2024, 1, 1), None),  # open: in force to the window's end
                ("P4", "Auto", None, D(2024, 1, 1), D(2024, 12, 30)),
                ("P5", "Boat", "TX", D(2024, 1, 1), D(2024, 12, 30)),  # no factor is known
                ("P6", "Auto", "TX", D(2024, 1, 2), D(2024, 1, 1)),  # in force on no day
            ],
            claim_policies(spark).schema,
        )
    )
    claims = spark.createDataFrame([("P3",), ("P3",), ("P4",), ("P5",), ("P6",)], "policy_id string")
    parameters = default_parameters(spark)
    got = derive.actual_vs_expected(policies, claims, parameters, window_end())
    columns = ("line_of_business", "state_code", "policies", "unknown_factor_policies", "actual_claims")
    assert sorted(row_set(got, *columns), key=str) == [
        ("Auto", "TX", 1, 0, 2), ("Auto", "ZZ", 1, 0, 0), ("Auto", None, 1, 0, 1), ("Boat", "TX", 0, 1, 0), ("Health", "FL", 1, 0, 0),
    ]
    expected = {r["policy_id"]: r["expected_claims"] for r in derive.expected_claims(policies, parameters, window_end()).collect()}
    assert expected["P5"] is None and expected["P3"] == pytest.approx(0.10 * 0.90 * 1.10 * 731 / 365)
    assert "P6" not in expected


def test_settlement(spark):
    df = spark.createDataFrame([("Paid",), ("Pending",), ("Denied",)], "claim_status string")
    settled = derive.settlement_amounts(df, F.lit("8.50").cast("decimal(18,2)"))
    assert row_set(settled) == [
        ("Denied", Decimal("0.00"), Decimal("0.00")), ("Paid", Decimal("8.50"), Decimal("8.50")), ("Pending", Decimal("8.50"), Decimal("0.00")),
    ]


def test_plan_premium_and_tax(spark):
    df = spark.createDataFrame(
        [("Life", "Premium", "Tier 1"), ("Auto", "Liability", "Tier 3"), ("Auto", "Nope", "Tier 9")],
        "line_of_business string, plan_name string, market_tier string",
    )
    parameters = default_parameters(spark)
    taxed = derive.premium_tax(derive.plan_premium(df, parameters.plans), parameters.tax_rates)
    assert row_set(taxed, "plan_name", "monthly_premium", "annual_premium", "premium_tax") == [
        ("Liability", Decimal("105.00"), Decimal("1260.00"), Decimal("31.50")),
        ("Nope", None, None, None),
        ("Premium", Decimal("310.00"), Decimal("3720.00"), Decimal("130.20")),
    ]


def test_expense_grid_has_every_month_of_every_state(spark):
    states = spark.createDataFrame([("NY", "NE", "Tier 1"), ("CA", "W", "Tier 1")], "state_code string, region_code string, market_tier string")
    expenses = spark.createDataFrame(
        [("NY", D(2024, 2, 1), Decimal(5)), ("NY", D(2024, 2, 9), Decimal(2)), ("TX", D(2024, 2, 1), Decimal(1))],
        "state_code string, expense_month date, expense_amount decimal(18,2)",
    )
    grid = derive.expense_grid(expenses, states, "2024-01-15", "2024-03-02")
    assert grid.count() == 6
    assert row_set(grid.where("expense_amount > 0"), "state_code", "expense_month", "expense_amount") == [
        ("NY", D(2024, 2, 1), Decimal("7.00"))
    ]


def test_yearly_stock_and_new(spark):
    df = spark.createDataFrame(
        [("A", 2022), ("A", 2024), ("A", 2024), ("B", 2025), (None, 2023), ("B", 2030)], "g string, y int"
    )
    stock = derive.yearly_stock(df, "y", 2023, 2025, ["g"])
    assert row_set(stock) == [
        (None, 2023, 1), (None, 2024, 1), (None, 2025, 1), ("A", 2023, 1), ("A", 2024, 3), ("A", 2025, 3),
        ("B", 2023, 0), ("B", 2024, 0), ("B", 2025, 1),
    ]
    falling = spark.createDataFrame([("A", 2023, 5), ("A", 2024, 5), ("A", 2025, 3)], "g string, year int, stock bigint")
    assert row_set(derive.yearly_new_from_stock(falling, ["g"]), "year", "new", "is_skipped", "is_falling") == [
        (2023, 5, False, False), (2024, 0, True, False), (2025, -2, True, True),
    ]


def test_state_lookup(spark):
    df = spark.createDataFrame([("P1", "WI"), ("P2", "ZZ")], "policy_id string, state_code string")
    looked_up = derive.state_lookup(df, default_parameters(spark).states)
    assert row_set(looked_up, "policy_id", "state_region", "state_tier") == [("P1", "MW", "Tier 3"), ("P2", None, None)]


def test_portfolio_targets(spark):
    clients = spark.range(3000).select(F.lit("all").alias("g"))
    targets = derive.portfolio_targets(clients, [2025, 2024], ["g"])
    assert row_set(targets, "year", "active_clients", "estimated_policies") == [(2024, 2142, 3748), (2025, 3000, 5250)]


def test_seasonal_allocation(spark):
    yearly = spark.createDataFrame([(2024, 1000)], "year int, n bigint")
    rows = derive.seasonal_allocation(yearly, "n", NEW_BUSINESS_WEIGHTS).orderBy("month").collect()
    assert len(rows) == 12 and sum(r.expected_new for r in rows) == pytest.approx(1000)
    assert rows[0].expected_new == pytest.approx(70) and rows[5].weight == pytest.approx(0.10)
    # weights are made to sum to one, none is below the floor
    skewed = derive.seasonal_allocation(yearly, "n", ["0", "0.98"]).orderBy("month").collect()
    assert [r.weight for r in skewed] == [0.02, 0.98]
    doubled = derive.seasonal_allocation(yearly, "n", ["2", "6"]).orderBy("month").collect()
    assert [r.weight for r in doubled] == [0.25, 0.75]

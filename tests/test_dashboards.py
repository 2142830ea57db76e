from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverbay.plans import dashboards
from tests.tables import money, row_set

D = datetime.date

PORTFOLIO = "year int, year_month string, active_policies bigint, total_annual_premium decimal(38,2), total_monthly_premium decimal(38,2), state_code string, region_code string, line_of_business string"


@pytest.fixture(scope="module")
def portfolio(spark):
    rows = [
        (2024, "2024-01", 2, money(240), money(20), "NY", "NE", "Auto"),
        (2024, "2024-01", 1, money(120), money(10), "CA", "W", "Life"),
        (2024, "2024-02", 4, None, None, "NY", "NE", None),
        (2025, "2025-01", 10, money(720), money(60), "CA", "W", "Auto"),
        (2025, "2025-01", 5, money(720), money(60), "NY", "NE", "Health"),
        (2025, "2025-01", 1, money(1), money(1), "TX", "W", "Health"),
        (2027, "2027-01", 1, money(1), money(1), "TX", "W", "Health"),
    ]
    return spark.createDataFrame(rows, PORTFOLIO)


def test_kpis(portfolio):
    assert row_set(dashboards.avg_monthly_active(portfolio)) == [(2024, 3.5), (2025, 16.0), (2027, 1.0)]
    assert row_set(dashboards.total_annual_premium(portfolio))[0] == (2024, money("360.00"))
    assert row_set(dashboards.total_monthly_premium(portfolio))[1] == (2025, money("121.00"))
    assert row_set(dashboards.avg_premium_per_policy(portfolio))[0] == (2024, 360 / 7)
    assert row_set(dashboards.yearly_kpis(portfolio))[0] == (2024, 3.5, 360.0, 30.0, 360 / 7)


def test_change_needs_the_prior_year_itself(portfolio):
    yearly = dashboards.yearly_kpis(portfolio)
    rows = row_set(dashboards.change_on_prior_year(yearly, ["total_monthly_premium"]))
    assert rows == [
        (2024, 30.0, None, None, None), (2025, 121.0, 30.0, 91.0, 91 / 30 * 100), (2027, 1.0, None, None, None),
    ]


def test_pivot_and_ranking(portfolio):
    assert row_set(dashboards.premium_exposure_by_month_line(portfolio))[0] == ("2024-01", money("20.00"), None, money("10.00"), None)
    rest = row_set(dashboards.premium_exposure_by_month_line(portfolio, ("Life",)), "year_month", "life", "other_lines")
    assert rest[0] == ("2024-01", money("10.00"), money("20.00"))
    ranked = dashboards.premium_by_state_line(portfolio, top=1)
    assert row_set(ranked, "year", "state_code", "state_rank") == [
        (2024, "NY", 1), (2024, "NY", 1), (2025, "CA", 1), (2025, "NY", 1), (2027, "TX", 1),
    ]
    everything = dashboards.premium_by_state_line(portfolio)
    assert row_set(everything.where("year = 2025"), "state_code", "state_rank") == [("CA", 1), ("NY", 1), ("TX", 2)]


def test_slices(portfolio):
    assert dashboards.slice_view(portfolio).count() == 7
    sliced = dashboards.slice_view(portfolio, line_of_business="Health", region_code="W", year=2025)
    assert row_set(sliced, "state_code") == [("TX",)]


def test_claims_rollup_rebuilds_ratios(spark):
    rows = [
        ("2024-01", "A", "NY", 1, 2, money(10), money(100)), ("2024-01", "B", "NY", 3, 3, money(20), money(0)),
        ("2024-01", "A", "CA", 1, 1, money(5), money(0)),
    ]
    claims = spark.createDataFrame(rows, "year_month string, product_key string, state_code string, exposed_policies bigint, claim_count bigint, total_losses decimal(38,2), total_premium decimal(38,2)")
    assert row_set(dashboards.claims_rollup(claims, ["state_code"])) == [
        ("2024-01", "CA", 1, 1, money("5.00"), money("0.00"), 1.0, 5.0, None),
        ("2024-01", "NY", 4, 5, money("30.00"), money("100.00"), 1.25, 6.0, 0.3),
    ]


def test_daily_dashboards(spark):
    operations = spark.createDataFrame(
        [(D(2024, 1, 1), "2024-01", "Auto", 2, 1, 0), (D(2024, 1, 1), "2024-01", "Life", 3, 0, 1), (D(2024, 1, 2), "2024-01", "Auto", 2, 4, 0)],
        "day_date date, year_month string, line_of_business string, active_policies bigint, policies_started bigint, policies_ended bigint",
    )
    assert row_set(dashboards.operations_by_day(operations)) == [(D(2024, 1, 1), 5, 1, 1), (D(2024, 1, 2), 2, 4, 0)]
    assert row_set(dashboards.new_policies_by_month_line(operations)) == [("2024-01", "Auto", 5), ("2024-01", "Life", 0)]

    risk = spark.createDataFrame(
        [(D(2024, 1, 1), 3, 5.0, 1, 1, 2), (D(2024, 1, 1), 1, 9.0, 1, 0, 0), (D(2024, 1, 1), 4, None, 0, 4, 0)],
        "day_date date, active_policies bigint, avg_risk_score double, high_risk_policies bigint, new_business_policies bigint, renewal_policies bigint",
    )
    assert row_set(dashboards.risk_by_day(risk)) == [(D(2024, 1, 1), 8, 6.0, 2, 5 / 8, 2 / 8)]
    assert row_set(dashboards.risk_by_day(risk.where(F.col("avg_risk_score").isNull())), "avg_risk_score") == [(None,)]


def test_mean_scores_of_half_scored_segments_add_up(spark):
    rows = [(D(2024, 1, 1), 10, Decimal("18.00"), 2, 1, 5, 5), (D(2024, 1, 1), 4, Decimal("4.00"), 4, 0, 2, 2), (D(2024, 1, 2), 3, Decimal("0"), 0, 0, 0, 3)]
    states = spark.createDataFrame(
        rows,
        "day_date date, active_policies bigint, score decimal(28,2), scored bigint, high_risk_policies bigint, "
        "new_business_policies bigint, renewal_policies bigint",
    )
    # two policies of the first segment have a score, 9 each: weighing its mean by ten would say 6.7
    assert row_set(dashboards.risk_by_day(states), "day_date", "avg_risk_score") == [(D(2024, 1, 1), 22 / 6), (D(2024, 1, 2), None)]

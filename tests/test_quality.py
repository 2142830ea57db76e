"""Every rule once on clean tables and once on tables that break it, with the count it reports."""

from __future__ import annotations

import datetime

import pytest

from coverbay.operators import quality
from coverbay.plans import views
from coverbay.schemas import RAW, STAR
from tests.tables import calendar_rows, money, raw_table, spark_star, star_table

D = datetime.date
START, END = D(2024, 1, 1), D(2024, 12, 30)


def client(id_="C1", year=2024, age=30):
    return (id_, year, age, "Male", "NY", "NE", "Tier 1", "Individual", 1)


def policy(id_, client_id="C1", start=START, end=END, renewal=False, score=5, premium=10):
    return (
        id_, "N", client_id, "Auto", "Full", "NY", "NE", start, end, "Active", renewal,
        money(score), money(premium), money(premium),
    )


def claim(id_, policy_id="P1", day=START, report=START, requested=10, approved=9, paid=9):
    return (id_, policy_id, day, report, "Theft", money(requested), money(approved), money(paid), "Paid")


def outcome(report):
    rows = report.collect()
    assert len(rows) == len({row.rule_id for row in rows})
    assert all(row.passed == (row.violations == 0) for row in rows)
    return {row.rule_id: row.violations for row in rows}


def raw_tables(spark, rows):
    return {name: raw_table(spark, name, table) for name, table in rows.items()}


CLEAN_RAW = {
    "clients": [client()],
    "policies": [policy(f"P{i}", renewal=i == 1) for i in range(1, 6)],
    "claims": [claim("K1")],
    "expenses": [(1, "Operating", "NY", "NE", START, money(1))],
    "taxes": [(1, "P1", "NY", money(1), money(0.03))],
}

BAD_RAW = {
    "clients": [client("C1"), client("C1"), client("C2", 2022, 17), client("C3", None, None), client("C4", 2026, 85)],
    "policies": [
        policy("P1", "C9", score=0.99, premium=0, renewal=True),
        policy("P1", None, score=None, premium=None, renewal=None),
        policy("P3", "C1", start=D(2025, 1, 2), end=D(2025, 1, 1), premium=-1),
        policy("P4", "C9", start=D(2022, 12, 31), end=D(2026, 1, 1)),
        policy("P5", "C8", end=None),
    ],
    "claims": [
        claim("K1", "P9", requested=-1),
        claim("K1", None, paid=10),
        claim("K2", "P9", report=D(2023, 12, 31)),
        claim("K3", "P8", day=D(2026, 1, 1), report=None, paid=None),
        claim("K4", "P1", day=D(2022, 1, 1)),
    ],
    "expenses": [
        (1, "Operating", "NY", "NE", D(2026, 1, 1), money(-1)),
        (1, "Operating", "NY", "NE", None, None),
    ],
    "taxes": [(None, "P1", "NY", money(-1), money(0.03)), (None, "P1", "NY", None, None)],
}

BAD_RAW_COUNTS = {
    "V-C2": 1, "V-C3": 3, "V-C4": 3,
    "V-P2": 1, "V-P3": 2, "V-P4": 2, "V-P5": 3, "V-P6": 1, "V-P7": 1,
    "V-K2": 1, "V-K3": 3, "V-K4": 1, "V-K5": 1, "V-K6": 2, "V-K7": 1, "V-CL6": 1,
    "V-E2": 1, "V-E3": 1, "V-E4": 1, "V-T2": 1, "V-T3": 1, "V-S1": 1, "V-S2": 0,
}


def test_raw_rules(spark):
    clean = quality.check_raw(spark, raw_tables(spark, CLEAN_RAW))
    assert set(outcome(clean).values()) == {0}
    quality.enforce(clean)

    report = quality.check_raw(spark, raw_tables(spark, BAD_RAW))
    found = outcome(report)
    assert {rule: found[rule] for rule in BAD_RAW_COUNTS} == BAD_RAW_COUNTS
    with pytest.raises(quality.QualityGateFailed, match="V-C2 \\(1\\)") as failed:
        quality.enforce(report)
    assert "V-K7" not in str(failed.value) and "V-S1" not in str(failed.value)


def test_raw_missing_tables_columns_and_rows(spark):
    tables = raw_tables(spark, CLEAN_RAW)
    del tables["taxes"]
    tables["clients"] = tables["clients"].drop("age", "gender")
    tables["claims"] = raw_table(spark, "claims", [])
    found = outcome(quality.check_raw(spark, tables))
    assert found["V-R1"] == 1
    assert found["V-C1"] == 2 and found["V-C3"] is None and found["V-C4"] == 0
    assert found["V-R2.claims"] == 1 and found["V-K2"] == 0 and found["V-K3"] == 0
    assert found["V-T1"] is None and found["V-T3"] is None
    assert found["V-S1"] == 1


def test_renewal_rate_bounds(spark):
    rows = {**CLEAN_RAW, "policies": [policy(f"P{i}", renewal=i < 3) for i in range(1, 6)]}
    assert outcome(quality.check_raw(spark, raw_tables(spark, rows)))["V-S2"] == 1


def test_null_reference_passes_when_the_parent_has_a_null(spark):
    rows = {**CLEAN_RAW, "clients": [client(), client(None)], "policies": [policy("P1", None), policy("P2")]}
    assert outcome(quality.check_raw(spark, raw_tables(spark, rows)))["V-P5"] == 0


def fact_policy(id_, product="AUTO_FULL", state="NY", start=20240101, end=20240102, year=2024):
    return (id_, product, state, "NE", start, end, year, 1, "Active", money(5), money(1), money(12))


def fact_claim(id_, policy_id="P1", product="AUTO_FULL", state="NY", day=20240101, report=20240101, settled=None):
    return (
        id_, policy_id, product, "Auto", state, "NE", "Theft", "Paid", False, day, report, settled, None,
        money(1), money(1), money(1),
    )


CLEAN_STAR = {
    "dim_time": calendar_rows(D(2024, 1, 1), D(2024, 1, 3)),
    "dim_state": [("NY", "NE", "Tier 1")],
    "dim_clients": [("C1", 2024, 30, "Male", "Individual", "NY", "NE", "Tier 1", 1)],
    "dim_products": [("AUTO_FULL", "Auto", "Full")],
    "dim_policies": [("P1", "N", "C1", "NY", "NE", False), ("P2", "N", "C1", "NY", "NE", True)],
    "fact_policies": [fact_policy("P1"), fact_policy("P2")],
    "fact_claims": [fact_claim("K1", settled=20240103)],
    "fact_expenses": [("1", "Operating", "NY", "NE", 20240101, money(1))],
    "fact_taxes": [("1", "P1", "PREMIUM_TAX", "NY", None, money(1), money(0.03), money(1))],
}

BAD_STAR = {
    "dim_time": [*calendar_rows(D(2024, 1, 1), D(2024, 1, 3)), calendar_rows(D(2024, 1, 3), D(2024, 1, 3))[0]],
    "dim_state": [("NY", "NE", "Tier 1"), ("NY", "NE", "Tier 2")],
    "dim_clients": [
        ("C1", 2024, 30, "Male", "Individual", "ZZ", "NE", "Tier 1", 1),
        ("C1", 2024, 30, "Male", "Individual", None, "NE", "Tier 1", 1),
        (None, 2024, 30, "Male", "Individual", "ZZ", "NE", "Tier 1", 1),
    ],
    "dim_products": [("AUTO_FULL", "Auto", "Full"), ("AUTO_FULL", "Auto", "full"), (None, "Auto", None)],
    "dim_policies": [
        ("P1", "N", "C9", "ZZ", "NE", False),
        ("P1", "N", "C9", "NY", "NE", False),
        ("P2", "N", "C8", None, "NE", False),
    ],
    "fact_policies": [
        fact_policy("P9", "NO_PLAN", "ZZ", 20230101, 20250101, 2023),
        fact_policy("P9", None, None, 20230101, None),
        fact_policy("P1", "NO_PLAN", "ZY", 20240101, 20250101),
    ],
    "fact_claims": [
        fact_claim("K1", "P9", "NO_PLAN", "ZZ", 20230101, 20230101, 20230101),
        fact_claim("K1", "P9", None, None, 20230101, 20230102, 20230101),
        fact_claim(None, None, "NO_PLAN", "ZZ", 20230102, None, None),
    ],
    "fact_expenses": [("1", "Operating", "ZZ", "NE", 20230101, money(-1)), ("1", "Operating", None, "NE", None, None)],
    "fact_taxes": [
        ("1", "P9", "PREMIUM_TAX", "ZZ", 20230101, money(1), money(0.03), money(-1)),
        ("2", None, "PREMIUM_TAX", None, None, money(1), money(0.03), money(1)),
    ],
}

BAD_STAR_COUNTS = {
    "star": {
        "V-TM2": 1, "V-ST2": 1, "V-DC1": 1, "V-DC2": 2, "V-PR1": 1, "V-DP1": 1, "V-DP2": 2, "V-DP3": 2,
        "V-FP1": 1, "V-FP2": 1, "V-FP3": 3, "V-FP4": 1, "V-FP5": 2,
        "V-CL1": 2, "V-CL2": 1, "V-CL3": 2, "V-CL4.incident": 2, "V-CL4.report": 3, "V-CL5": 1,
        "V-FE1": 2, "V-FE2": 2, "V-FE3": 1, "V-FT1": 2, "V-FT2": 2, "V-FT3": 1, "V-S3": 1,
    },
    "loaded": {"V-L2": 3, "V-L3": 2, "V-L4": 2, "V-L5": 2, "V-L6": 2, "V-L7": 2, "V-L8": 2, "V-L9": 3},
    "ddl": {
        "V-D1.dim_time": 1, "V-D1.dim_state": 1, "V-D1.dim_clients": 2, "V-D1.dim_products": 2, "V-D1.dim_policies": 1,
        "V-D1.fact_policies": 1, "V-D1.fact_claims": 2, "V-D1.fact_expenses": 1, "V-D1.fact_taxes": 0,
        "V-D2": 2, "V-D3": 1, "V-D4": 2, "V-D5": 2, "V-D6.state": 1, "V-D6.date": 1, "V-D7.state": 1, "V-D7.date": 1,
        "V-D8": 1,
    },
}


def test_clean_star_passes_every_rule(spark):
    star = spark_star(spark, CLEAN_STAR)
    tables = quality.check_tables(spark, star)
    assert set(outcome(tables).values()) == {0}
    declared = quality.star_rules() + quality.constraint_rules() + quality.loaded_rules()
    assert len(outcome(tables)) == len(declared) + 1
    quality.enforce(tables)
    loaded = outcome(quality.check_views(spark, star, views.build_views(star)))
    assert loaded == {"V-L11": 0, **{f"V-L10.{view}": 0 for view in views.BUILDERS}}


def test_bad_star_counts(spark):
    star = spark_star(spark, BAD_STAR)
    for stage, check in [("star", quality.check_star), ("ddl", quality.check_constraints)]:
        found = outcome(check(spark, star))
        expected = BAD_STAR_COUNTS[stage]
        assert {rule: found[rule] for rule in expected} == expected, stage
    found = outcome(quality.run_rules(spark, {"loaded": quality.loaded_rules()}, star))
    expected = BAD_STAR_COUNTS["loaded"]
    assert {rule: found[rule] for rule in expected} == expected


def test_empty_and_missing_star_tables(spark):
    rows = {**CLEAN_STAR, "fact_claims": [], "fact_policies": []}
    star = spark_star(spark, rows)
    found = outcome(quality.check_loaded(spark, star, views.build_views(star)))
    assert found["V-L1.fact_claims"] == 1 and found["V-L1.dim_time"] == 0 and found["V-L11"] == 0
    assert {found[f"V-L10.{view}"] for view in views.BUILDERS} == {1}
    del star["dim_products"]
    found = outcome(quality.check_star(spark, star))
    assert found["V-N1"] == 1 and found["V-FP2"] is None and found["V-N1.dim_products"] is None
    assert found["V-S3"] == 1


def test_required_columns(spark):
    star = spark_star(spark, CLEAN_STAR)
    star["dim_time"] = star["dim_time"].drop("quarter", "is_weekend")
    star["dim_state"] = star["dim_state"].drop("market_tier")
    found = outcome(quality.check_star(spark, star))
    assert (found["V-TM1"], found["V-ST1"]) == (2, 1)


def test_every_declared_rule_is_tested():
    tested = {**BAD_RAW_COUNTS, **{r: n for s in BAD_STAR_COUNTS.values() for r, n in s.items()}}
    others = {"V-C1", "V-P1", "V-K1", "V-E1", "V-T1", "V-TM1", "V-ST1"}
    for rule in quality.raw_rules() + quality.star_rules() + quality.loaded_rules() + quality.constraint_rules():
        if rule.rule_id not in others and not isinstance(rule, quality.NotEmpty):
            assert rule.rule_id in tested, rule.rule_id
    assert set(RAW) | set(STAR) == set(quality.PRIMARY_KEY)


def test_key_rules_read_a_table_once_and_join_nothing(spark):
    star = spark_star(spark, CLEAN_STAR)
    star = {name: star_table(spark, name, CLEAN_STAR[name]) for name in star}
    frames = quality._key_results(quality.star_rules(), star)
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Scan ExistingRDD") == len(STAR)

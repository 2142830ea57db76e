"""Projection of the TPC-H-like test tables onto the five raw insurance tables.

The test data has no insurance tables, so orders play policies, customers play clients and line
items play claims. FIXTURES.md section 3 lists the mapping.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coverbay.functions.numbers import money_round
from coverbay.functions.text import padded_id
from coverbay.operators import derive
from coverbay.sources.parameters import PLANS, Parameters, default_parameters

END = "2001-08-01"
YEARS = (1994, 2001)
WINDOW = ("1995-01-01", END)

LINE_PLANS: dict[str, list[str]] = {}
for _line, _plan, _ in PLANS:
    LINE_PLANS.setdefault(_line, []).append(_plan)

# Claim types of each line of business.
CLAIM_TYPES = {
    "Life": ["Death", "Terminal_Illness", "Disability"],
    "Health": ["Hospitalization", "Surgery", "Emergency_Room", "Specialist_Visit", "Prescription"],
    "Auto": ["Collision", "Liability", "Theft", "Weather_Damage", "Vandalism"],
}

FLAG_TEXTS = ["true", "T", "yes", "1", "no", "0", None]


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select(
        "n_nationkey",
        F.col("n_name").alias("state_code"),
        F.col("r_name").alias("region_code"),
        _pick(["Tier 1", "Tier 2", "Tier 3"], F.col("n_nationkey") % 3).alias("market_tier"),
    )


def parameters(spark: SparkSession, sf_dir: str) -> Parameters:
    """Default parameters with the stand-in's states; every fifth state has no climate factor."""
    listed = states(spark, sf_dir)
    key = F.col("n_nationkey")
    climate = listed.where(key % 5 != 0).select(
        "state_code", (key * F.lit("0.01").cast("decimal(4,2)") + F.lit("0.90").cast("decimal(4,2)"))
        .cast("decimal(6,4)").alias("climate")
    )
    return replace(default_parameters(spark), states=listed.drop("n_nationkey"), climate=climate)


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    key, last_digit = F.col("c_custkey"), F.col("c_custkey") % 10
    return customer.join(states(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        # twice a millionth of the balance in cents is the balance over 5000, exactly
        (F.col("c_acctbal").cast("decimal(18,2)") * F.lit("0.0002").cast("decimal(6,4)")).alias("deviation"),
        padded_id("C", key, 7).alias("client_id"),
        (key % 8 + 1994).cast("int").alias("registration_year"),
        (key * 7 % 67 + 18).cast("int").alias("age"),
        F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
        "state_code",
        "region_code",
        "market_tier",
        F.when(last_digit == 0, "Corporate").otherwise("Individual").alias("customer_segment"),
        F.when(last_digit < 6, 1).when(last_digit < 9, 2).otherwise(3).alias("max_policies_allowed"),
    )


def _policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, slot = F.col("o_orderkey"), F.col("o_orderkey") % 20
    plan = F.expr("o_orderkey div 20 % 3")
    line = F.when(slot < 9, "Health").when(slot < 16, "Auto").otherwise("Life")
    plan_name = F.lit(None)
    for name, plans in LINE_PLANS.items():
        plan_name = F.when(line == name, _pick(plans, plan)).otherwise(plan_name)
    effective = F.col("o_orderdate").cast("date")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        line.alias("line_of_business"),
        plan_name.alias("plan_name"),
        effective.alias("effective_date"),
        F.when(F.col("o_orderstatus") != "O", derive.policy_end(effective, F.lit(END).cast("date"))).alias(
            "expiration_date"
        ),
    )
    held = orders.join(_clients(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    priced = derive.plan_premium(held, default_parameters(spark).plans)
    year = F.year("effective_date")
    return priced.select(
        "o_orderkey",
        padded_id("P", key, 8).alias("policy_id"),
        F.concat(F.lit("POL-"), year.cast("string"), padded_id("-", key, 6)).alias("policy_number"),
        "client_id",
        "line_of_business",
        "plan_name",
        "state_code",
        "region_code",
        "effective_date",
        "expiration_date",
        F.lit("Active").alias("status"),
        derive.is_renewal(F.col("registration_year"), year).alias("is_renewal"),
        derive.risk_score(F.col("age"), F.col("customer_segment"), F.col("deviation")).alias("risk_score"),
        "monthly_premium",
        "annual_premium",
    )


def _claims(spark: SparkSession, sf_dir: str, policies: DataFrame) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"
    )
    terms = policies.select(
        "o_orderkey", "policy_id", "line_of_business", "effective_date", "expiration_date"
    )
    joined = lines.join(terms, F.col("l_orderkey") == F.col("o_orderkey"))
    part, supplier, end = F.col("l_partkey"), F.col("l_suppkey"), F.lit(END).cast("date")
    incident = F.least(
        F.date_add("effective_date", (part % 365).cast("int")), F.coalesce("expiration_date", end)
    )
    roll = part % 100
    status = F.when(roll < 80, "Paid").when(roll < 93, "Pending").otherwise("Denied")
    claim_type = F.lit(None)
    for line, types in CLAIM_TYPES.items():
        claim_type = F.when(
            F.col("line_of_business") == line, _pick(types, supplier % len(types))
        ).otherwise(claim_type)
    requested = F.col("l_extendedprice").cast("decimal(18,2)")
    share = F.lit("0.95").cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)") * 2
    with_dates = joined.withColumns(
        {
            "incident_date": incident,
            "claim_status": status,
            "claim_amount_requested": requested,
            "offered": money_round(requested * share),
        }
    )
    settled = derive.settlement_amounts(with_dates, F.col("offered"))
    return settled.select(
        F.concat_ws(
            "-",
            F.concat(F.lit("CL"), F.col("l_orderkey").cast("string")),
            *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")],
            F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("claim_id"),
        "policy_id",
        "incident_date",
        derive.report_date(F.col("incident_date"), (supplier % 31).cast("int"), end).alias("report_date"),
        claim_type.alias("claim_type"),
        "claim_amount_requested",
        "claim_amount_approved",
        "claim_amount_paid",
        "claim_status",
        _pick(FLAG_TEXTS, part % 7).alias("fraud_flag"),
    )


def _expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # the calendar ends with the window, and so does the time in which an expense is booked
    ship_day = F.least(F.col("l_shipdate").cast("date"), F.lit(END).cast("date"))
    shipped = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.trunc(ship_day, "month").alias("expense_month"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    )
    by_state = (
        shipped.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "expense_month")
        .agg(F.sum("amount").alias("amount"))
    )
    month_number = F.year("expense_month") * 100 + F.month("expense_month")
    return by_state.join(states(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("n_nationkey").cast("bigint") * 1000000 + month_number).alias("expense_id"),
        F.lit("Operating").alias("expense_category"),
        "state_code",
        "region_code",
        "expense_month",
        money_round(F.col("amount") * F.lit("0.01").cast("decimal(4,2)")).alias("expense_amount"),
    )


def _taxes(spark: SparkSession, sf_dir: str, policies: DataFrame) -> DataFrame:
    tiers = states(spark, sf_dir).select("state_code", "market_tier")
    hundredth = F.lit("0.01").cast("decimal(4,2)")
    factor = ((F.col("o_orderkey") % 11 + 95) * hundredth).cast("decimal(4,2)")
    taxed = derive.premium_tax(
        policies.join(tiers, "state_code", "left"), default_parameters(spark).tax_rates, factor
    )
    return taxed.select(
        F.col("o_orderkey").alias("tax_id"),
        "policy_id",
        "state_code",
        F.col("premium_tax").alias("tax_amount"),
        "tax_rate",
    )


def raw_tables(
    spark: SparkSession, sf_dir: str, stage: Callable[[DataFrame], DataFrame] = lambda table: table
) -> dict[str, DataFrame]:
    """The five raw tables; ``stage`` may keep policies and claims, which many jobs read, once computed."""
    policies = stage(_policies(spark, sf_dir))
    return {
        "clients": _clients(spark, sf_dir).drop("c_custkey", "deviation"),
        "policies": policies.drop("o_orderkey"),
        "claims": stage(_claims(spark, sf_dir, policies)),
        "expenses": _expenses(spark, sf_dir),
        "taxes": _taxes(spark, sf_dir, policies),
    }

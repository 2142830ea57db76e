"""Raw operational tables → star schema of five dimensions and four facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from coverbay.functions.dates import (
    date_key,
    is_weekend,
    iso_weekday,
    lenient_date,
    month_key,
    strict_date,
)
from coverbay.functions.text import product_key, tolerant_flag
from coverbay.operators.skew import salted_join
from coverbay.schemas import STAR

TAX_TYPE = "PREMIUM_TAX"


def _in_load_order(df: DataFrame, table: str) -> DataFrame:
    """Columns of a warehouse table in its load order and with its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR[table]])


def _date_bounds(df: DataFrame, *columns: str) -> DataFrame:
    dates = [lenient_date(df, name) for name in columns]
    return df.agg(
        F.min(F.least(*dates)).alias("first_day"),
        F.max(F.greatest(*dates)).alias("last_day"),
    )


def build_dim_time(policies: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per day from the first to the last policy or claim date.

    Each input is reduced to one row by a map-side aggregate; only those two rows meet.
    """
    bounds = _date_bounds(policies, "effective_date", "expiration_date").unionByName(
        _date_bounds(claims, "incident_date", "report_date")
    )
    day = F.col("full_date")
    days = bounds.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")).select(
        F.explode(F.sequence("first_day", "last_day")).alias("full_date")
    )
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        iso_weekday(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
    )


def build_dim_state(clients: DataFrame) -> DataFrame:
    """Distinct (state, region, tier); a state with two regions or tiers keeps both rows.

    Rows carry no order: sort where the table is shown.
    """
    return _in_load_order(clients, "dim_state").distinct()


def first_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One whole row per key: the smallest by the remaining columns, NULLs first.

    The choice does not depend on file order. Keys are counted by hash, and rows whose key occurs
    once pass through a hash join unsorted; only rows of repeated keys are compared, by a ``min`` that
    combines before it shuffles, so a key that repeats very often never gathers in one task.
    """
    rest = [name for name in columns if name != key]
    repeated = df.groupBy(F.col(key).alias("repeated_key")).agg(F.count("*").alias("n")).where("n > 1")
    flagged = df.select(columns).join(
        repeated.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("repeated_key")), "left"
    )
    once = flagged.where(F.col("n").isNull()).select(columns)
    chosen = flagged.where(F.col("n").isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
    return once.unionByName(chosen.select(key, "row.*").select(columns))


def build_dim_clients(clients: DataFrame) -> DataFrame:
    return first_per_key(_in_load_order(clients, "dim_clients"), "client_id", STAR["dim_clients"].names)


def _policy_product_key() -> Column:
    return product_key(F.col("line_of_business"), F.col("plan_name"))


def build_dim_products(policies: DataFrame) -> DataFrame:
    products = policies.select("line_of_business", "plan_name").distinct()
    return _in_load_order(products.withColumn("product_key", _policy_product_key()), "dim_products")


def build_dim_policies(policies: DataFrame) -> DataFrame:
    return first_per_key(
        _in_load_order(policies, "dim_policies"), "policy_id", STAR["dim_policies"].names
    )


def build_fact_policies(policies: DataFrame) -> DataFrame:
    """One row per raw policy row; a projection, nothing is shuffled."""
    effective = strict_date(policies, "effective_date")
    expiration = strict_date(policies, "expiration_date")
    keyed = policies.withColumns(
        {
            "product_key": _policy_product_key(),
            "effective_date_key": date_key(effective),
            "expiration_date_key": date_key(expiration),
            "policy_year": F.year(effective),
            "policy_month": F.month(effective),
        }
    )
    return _in_load_order(keyed, "fact_policies")


def build_fact_claims(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with state, region and product of their policy; NULL where the policy is unknown.

    A policy, or a missing policy id, may hold a large share of all claims: such keys are cut
    into slices for the join.
    """
    attributes = policies.select(
        "policy_id", "state_code", "region_code", "line_of_business", "plan_name"
    )
    flag = tolerant_flag(F.col("fraud_flag")) if "fraud_flag" in claims.columns else F.lit(False)
    keyed = salted_join(claims, attributes, "policy_id", spread_by="claim_id").withColumns(
        {
            "product_key": _policy_product_key(),
            "fraud_flag": flag,
            "incident_date_key": date_key(strict_date(claims, "incident_date")),
            "report_date_key": date_key(strict_date(claims, "report_date")),
            "settlement_date_key": F.lit(None),
            "days_to_settle": F.lit(None),
        }
    )
    return _in_load_order(keyed, "fact_claims")


def build_fact_expenses(expenses: DataFrame) -> DataFrame:
    """Expenses keyed by the first day of their month."""
    month = strict_date(expenses, "expense_month")
    return _in_load_order(expenses.withColumn("date_key", month_key(month)), "fact_expenses")


def build_fact_taxes(taxes: DataFrame) -> DataFrame:
    """Premium taxes per policy; the base is recovered from amount and rate when not given."""
    if "tax_base" not in taxes.columns:
        # both in whole ten-thousandths of their unit, so the quotient is rounded once, half up
        numerator = (F.col("tax_amount") * 100).cast("decimal(20,0)") * F.lit(100_000_000).cast("decimal(9,0)") * 2
        rate = (F.col("tax_rate") * 10_000).cast("decimal(10,0)")
        whole = F.when(rate != 0, (numerator + rate).cast("decimal(38,0)"))
        millionths = F.floor(F.try_divide(whole, rate * 2)).cast("decimal(32,0)")
        taxes = taxes.withColumn("tax_base", (millionths * F.lit("0.000001").cast("decimal(6,6)")))
    keyed = taxes.withColumns({"tax_type": F.lit(TAX_TYPE), "date_key": F.lit(None)})
    return _in_load_order(keyed, "fact_taxes")


def build_star(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine tables as lazy DataFrames, dimensions first."""
    clients, policies, claims = raw["clients"], raw["policies"], raw["claims"]
    return {
        "dim_time": build_dim_time(policies, claims),
        "dim_state": build_dim_state(clients),
        "dim_clients": build_dim_clients(clients),
        "dim_products": build_dim_products(policies),
        "dim_policies": build_dim_policies(policies),
        "fact_policies": build_fact_policies(policies),
        "fact_claims": build_fact_claims(claims, policies),
        "fact_expenses": build_fact_expenses(raw["expenses"]),
        "fact_taxes": build_fact_taxes(raw["taxes"]),
    }

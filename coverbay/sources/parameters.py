"""Business parameters: the defaults and the reader of a configuration document."""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# States with region and market tier.
STATES = [
    ("NY", "NE", "Tier 1"),
    ("PA", "NE", "Tier 2"),
    ("MA", "NE", "Tier 1"),
    ("NJ", "NE", "Tier 2"),
    ("CT", "NE", "Tier 2"),
    ("FL", "SE", "Tier 1"),
    ("GA", "SE", "Tier 2"),
    ("NC", "SE", "Tier 2"),
    ("SC", "SE", "Tier 3"),
    ("IL", "MW", "Tier 2"),
    ("OH", "MW", "Tier 2"),
    ("MI", "MW", "Tier 2"),
    ("WI", "MW", "Tier 3"),
    ("CA", "W", "Tier 1"),
    ("TX", "W", "Tier 2"),
    ("WA", "W", "Tier 1"),
    ("OR", "W", "Tier 2"),
    ("AZ", "W", "Tier 3"),
]

# Monthly base price of each plan.
PLANS = [
    ("Life", "Basic", 55),
    ("Life", "Standard", 120),
    ("Life", "Premium", 310),
    ("Health", "Bronze", 460),
    ("Health", "Silver", 690),
    ("Health", "Gold", 1080),
    ("Auto", "Liability", 105),
    ("Auto", "Standard", 195),
    ("Auto", "Full", 340),
]

# Expected claims per policy and year.
BASELINE_FREQUENCY = [("Life", "0.005"), ("Health", "0.25"), ("Auto", "0.10")]

# Claim seasonality, January to December.
CLAIM_SEASONALITY = [
    "0.90", "0.92", "0.96", "1.00", "1.05", "1.10", "1.14", "1.12", "1.08", "1.00", "0.95", "0.92",
]

# Claim factor of a state; states not listed have DEFAULT_CLIMATE.
CLIMATE = [
    ("NY", "1.03"), ("PA", "1.00"), ("MA", "0.98"), ("NJ", "1.01"), ("CT", "0.99"),
    ("FL", "1.18"), ("GA", "1.05"), ("NC", "1.04"), ("SC", "1.06"),
    ("IL", "0.97"), ("OH", "0.96"), ("MI", "0.95"), ("WI", "0.94"),
    ("CA", "1.12"), ("TX", "1.10"), ("WA", "1.04"), ("OR", "1.02"), ("AZ", "1.08"),
]
DEFAULT_CLIMATE = "1.00"

# Premium tax rate of a market tier.
TIER_TAX_RATE = [("Tier 1", "0.035"), ("Tier 2", "0.030"), ("Tier 3", "0.025")]

# Share of a year's new policies by month, January to December.
NEW_BUSINESS_WEIGHTS = [
    "0.07", "0.07", "0.08", "0.08", "0.09", "0.10", "0.10", "0.09", "0.08", "0.08", "0.08", "0.08",
]

# Yearly client growth and policies per client.
GROWTH_RATE = 0.40
POLICIES_PER_CLIENT = 1.75

# First and last day of the data window.
WINDOW = ("2024-01-01", "2025-12-31")

CONFIG_SCHEMA = """
    time struct<start_date: string, end_date: string, years: array<int>>,
    portfolio struct<
        avg_policies_per_client: double,
        by_year: map<string, struct<active_clients: bigint, estimated_policies: bigint>>>,
    organization struct<states: array<struct<state_code: string, region_code: string, market_tier: string>>>,
    products map<string, map<string, struct<base_monthly_premium: decimal(18,2)>>>,
    claims struct<
        baseline_frequency: map<string, decimal(6,4)>,
        seasonality_by_month: map<string, decimal(6,4)>,
        climate_sensitivity_by_state: map<string, decimal(6,4)>,
        default_climate_factor: decimal(6,4)>
"""


@dataclass(frozen=True)
class Parameters:
    """Lookup tables, each a DataFrame whose size Spark knows when it plans a join."""

    states: DataFrame  # state_code, region_code, market_tier
    plans: DataFrame  # line_of_business, plan_name, base_monthly_premium
    baseline: DataFrame  # line_of_business, baseline_frequency
    seasonality: DataFrame  # month, seasonality
    climate: DataFrame  # state_code, climate
    tax_rates: DataFrame  # market_tier, tier_rate
    default_climate: str = DEFAULT_CLIMATE
    window: tuple[str, str] = WINDOW
    years: tuple[int, ...] = (2024, 2025)
    policies_per_client: float = POLICIES_PER_CLIENT
    growth_rate: float = GROWTH_RATE
    new_business_weights: tuple[str, ...] = tuple(NEW_BUSINESS_WEIGHTS)
    targets: dict[int, tuple[int, int]] | None = None  # year: active clients, estimated policies


def literal_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small table from Python values; it plans as a local scan of known size."""
    names = columns.split()
    data = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(data))


def _decimal(df: DataFrame, name: str, type_name: str = "decimal(6,4)") -> DataFrame:
    return df.withColumn(name, F.col(name).cast(type_name))


def _by_month(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    table = literal_table(spark, f"month {name}", list(enumerate(values, start=1)))
    return _decimal(table.withColumn("month", F.col("month").cast("int")), name)


def default_parameters(spark: SparkSession) -> Parameters:
    plans = literal_table(spark, "line_of_business plan_name base_monthly_premium", PLANS)
    return Parameters(
        states=literal_table(spark, "state_code region_code market_tier", STATES),
        plans=_decimal(plans, "base_monthly_premium", "decimal(18,2)"),
        baseline=_decimal(
            literal_table(spark, "line_of_business baseline_frequency", BASELINE_FREQUENCY),
            "baseline_frequency",
        ),
        seasonality=_by_month(spark, "seasonality", CLAIM_SEASONALITY),
        climate=_decimal(literal_table(spark, "state_code climate", CLIMATE), "climate"),
        tax_rates=_decimal(literal_table(spark, "market_tier tier_rate", TIER_TAX_RATE), "tier_rate"),
    )


def read_parameters(spark: SparkSession, path: str) -> Parameters:
    """Parameters of a JSON configuration document; parts it does not hold keep their defaults."""
    defaults = default_parameters(spark)
    document = spark.read.schema(CONFIG_SCHEMA).option("multiLine", True).json(path)
    # one row; which parts it holds, and its single values
    head = document.select(
        F.size("organization.states").alias("states"),
        F.size("products").alias("plans"),
        F.size("claims.baseline_frequency").alias("baseline"),
        F.size("claims.seasonality_by_month").alias("seasonality"),
        F.size("claims.climate_sensitivity_by_state").alias("climate"),
        "claims.default_climate_factor",
        "time",
        "portfolio",
    ).first()

    def entries(column: str, key: str, value: str) -> DataFrame:
        return document.select(F.explode(column).alias(key, value))

    by_line = document.select(F.explode("products").alias("line_of_business", "line_plans"))
    plans = by_line.select("line_of_business", F.explode("line_plans").alias("plan_name", "plan"))
    tables = {
        "states": document.select(F.inline("organization.states")),
        "plans": plans.select("line_of_business", "plan_name", "plan.base_monthly_premium"),
        "baseline": entries("claims.baseline_frequency", "line_of_business", "baseline_frequency"),
        "seasonality": entries("claims.seasonality_by_month", "month", "seasonality").withColumn(
            "month", F.col("month").cast("int")
        ),
        "climate": entries("claims.climate_sensitivity_by_state", "state_code", "climate"),
    }
    given: dict = {name: table for name, table in tables.items() if (head[name] or -1) >= 0}
    if head["default_climate_factor"] is not None:
        given["default_climate"] = str(head["default_climate_factor"])
    time, portfolio = head["time"], head["portfolio"]
    if time is not None:
        given["window"] = (time["start_date"] or WINDOW[0], time["end_date"] or WINDOW[1])
        if time["years"]:
            given["years"] = tuple(time["years"])
    if portfolio is not None:
        if portfolio["avg_policies_per_client"] is not None:
            given["policies_per_client"] = portfolio["avg_policies_per_client"]
        if portfolio["by_year"]:
            given["targets"] = {
                int(year): (target["active_clients"], target["estimated_policies"])
                for year, target in portfolio["by_year"].items()
            }
    return replace(defaults, **given)

"""Small hand-made tables, and a random star with every awkward case the views must handle."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from coverbay.schemas import RAW, RAW_OPTIONAL, STAR

D = datetime.date


def money(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))


def star_table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, STAR[name])


def raw_table(spark: SparkSession, name: str, rows: list[tuple], optional: bool = False) -> DataFrame:
    schema = RAW[name]
    if optional:
        for field in RAW_OPTIONAL[name]:
            schema = type(schema)(schema.fields + [field])
    return spark.createDataFrame(rows, schema)


def key(day: D) -> int:
    return int(f"{day:%Y%m%d}")


def calendar_rows(first: D, last: D) -> list[tuple]:
    rows = []
    day = first
    while day <= last:
        rows.append(
            (
                key(day),
                day,
                day.year,
                day.month,
                f"{day:%B}",
                (day.month + 2) // 3,
                f"{day:%Y-%m}",
                day.isoweekday(),
                day.isoweekday() >= 6,
            )
        )
        day += datetime.timedelta(days=1)
    return rows


FIRST, LAST = D(2024, 1, 10), D(2024, 5, 20)
PRODUCTS = [("AUTO_FULL", "Auto", "Full"), ("AUTO_BASIC", "Auto", "Basic"), ("LIFE_BASIC", "Life", "Basic")]
STATES = [("NY", "NE"), ("CA", "W"), (None, "W"), ("TX", None)]


def random_star_rows(seed: int, policies: int = 150, claims: int = 200) -> dict[str, list[tuple]]:
    """Terms before, across and after the calendar, reversed terms, unknown products, NULLs."""
    rng = random.Random(seed)
    facts, headers = [], []
    for i in range(policies):
        start = FIRST + datetime.timedelta(days=rng.randrange(-40, (LAST - FIRST).days + 20))
        length = rng.choice([0, 0, 1, 5, 28, 31, 60, 200, -3])
        end = start + datetime.timedelta(days=length)
        if rng.random() < 0.05:
            end = LAST
        state, region = rng.choice(STATES)
        other_state, other_region = rng.choice([(state, region), rng.choice(STATES)])
        product = rng.choice([p[0] for p in PRODUCTS] + ["UNKNOWN_A", "UNKNOWN_B", None])
        premium = rng.choice([None, 0, 10.5, 99.99, 120])
        if product == "LIFE_BASIC" and state == "CA":
            premium = None
        score = rng.choice([None, 0.5, 0.8, 3.25, 7, 9.99])
        facts.append(
            (
                f"P{i:04d}",
                product,
                state,
                region,
                key(start),
                None if rng.random() < 0.25 else key(end),
                start.year,
                start.month,
                "Active",
                money(score),
                money(premium),
                None if premium is None else money(round(premium * 12, 2)),
            )
        )
        if rng.random() < 0.95:
            renewal = rng.choice([True, False, None])
            headers.append((f"P{i:04d}", f"N{i}", "C1", other_state, other_region, renewal))
    claim_rows = []
    for i in range(claims):
        day = FIRST + datetime.timedelta(days=rng.randrange(-10, (LAST - FIRST).days + 10))
        policy = rng.choice([f"P{rng.randrange(policies):04d}", "P0001", "P0001", "NOPE", None])
        paid = rng.choice([None, 0, 12.34, 500])
        claim_rows.append(
            (
                f"K{i}",
                policy,
                "AUTO_FULL",
                "Auto",
                "NY",
                "NE",
                "Theft",
                "Paid",
                False,
                key(day),
                key(day),
                None,
                None,
                money(paid),
                money(paid),
                money(paid),
            )
        )
    return {
        "dim_time": calendar_rows(FIRST, LAST),
        "dim_products": PRODUCTS,
        "dim_policies": headers,
        "fact_policies": facts,
        "fact_claims": claim_rows,
    }


def spark_star(spark: SparkSession, rows: dict[str, list[tuple]]) -> dict[str, DataFrame]:
    return {name: star_table(spark, name, table) for name, table in rows.items()}


def row_set(df: DataFrame, *columns: str) -> list[tuple]:
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])

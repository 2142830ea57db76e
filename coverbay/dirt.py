"""Deliberate faults in the stand-in tables, so that quality rules have something to find.

Rows are dropped, repeated and changed by predicates on their keys. The predicates are plain SQL that
Spark and DuckDB read alike, so the oracles apply the same faults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Dirt:
    drop: str = "false"
    repeat: str = "false"
    change: dict[str, str] = field(default_factory=dict)  # column: new value, NULL keeps the old one
    clear: dict[str, str] = field(default_factory=dict)  # column: rows that lose their value
    without: tuple[str, ...] = ()  # columns that are not there
    absent: bool = False  # the table is not there


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


RAW_DIRT = {
    "clients": Dirt(
        drop="client_id LIKE '%8'",
        repeat="client_id LIKE '%5'",
        change={
            "age": _when("client_id LIKE '%3'", "10"),
            "registration_year": _when("client_id LIKE '%4'", "1980"),
        },
    ),
    "policies": Dirt(
        drop="policy_id LIKE '%6'",
        repeat="policy_id LIKE '%4'",
        change={
            "risk_score": _when("policy_id LIKE '%1'", "CAST(0 AS DECIMAL(4,2))"),
            "monthly_premium": _when("policy_id LIKE '%2'", "CAST(-1 AS DECIMAL(18,2))"),
            "effective_date": (
                "CASE WHEN policy_id LIKE '%3' THEN DATE '2031-01-01' WHEN policy_id LIKE '%9' THEN DATE '1990-01-01' END"
            ),
            "is_renewal": "true",
        },
    ),
    "claims": Dirt(
        repeat="claim_id LIKE '%6'",
        change={
            "claim_amount_requested": _when("claim_id LIKE '%1'", "CAST(-1 AS DECIMAL(18,2))"),
            "claim_amount_paid": _when("claim_id LIKE '%2'", "CAST(claim_amount_approved + 1 AS DECIMAL(18,2))"),
            "incident_date": _when("claim_id LIKE '%3'", "DATE '1980-01-01'"),
            "report_date": _when("claim_id LIKE '%4'", "DATE '1970-01-01'"),
        },
        clear={"policy_id": "claim_id LIKE '%5'"},
    ),
    "expenses": Dirt(
        repeat="expense_id % 7 = 0",
        change={
            "expense_amount": _when("expense_id % 3 = 0", "CAST(-1 AS DECIMAL(18,2))"),
            "expense_month": _when("expense_id % 5 = 0", "DATE '1990-01-01'"),
        },
    ),
    "taxes": Dirt(
        repeat="tax_id % 7 = 0",
        change={"tax_amount": _when("tax_id % 3 = 0", "CAST(-1 AS DECIMAL(18,2))")},
    ),
}

STAR_DIRT = {
    "dim_time": Dirt(drop="date_key % 100 = 15 OR date_key % 10000 = 301", repeat="date_key % 100 = 2"),
    "dim_state": Dirt(drop="state_code LIKE '%1'", repeat="state_code LIKE '%2'"),
    "dim_clients": Dirt(drop="client_id LIKE '%3'", repeat="client_id LIKE '%4'"),
    "dim_products": Dirt(drop="product_key LIKE 'AUTO%'", repeat="product_key LIKE 'LIFE%'"),
    "dim_policies": Dirt(drop="policy_id LIKE '%5'", repeat="policy_id LIKE '%6'"),
    "fact_policies": Dirt(
        repeat="policy_id LIKE '%7'", change={"policy_year": _when("policy_id LIKE '%8'", "1900")}
    ),
    "fact_claims": Dirt(
        repeat="claim_id LIKE '%9'", change={"settlement_date_key": _when("claim_id LIKE '%1'", "19000101")}
    ),
    "fact_expenses": Dirt(
        repeat="expense_id LIKE '%3'",
        change={"expense_amount": _when("expense_id LIKE '%2'", "CAST(-1 AS DECIMAL(18,2))")},
    ),
    "fact_taxes": Dirt(
        repeat="tax_id LIKE '%3'",
        change={
            "tax_amount": _when("tax_id LIKE '%2'", "CAST(-1 AS DECIMAL(18,2))"),
            "date_key": _when("tax_id LIKE '%4'", "19000101"),
        },
    ),
}

# Ids that repeat with equal, overlapping and touching terms in one segment and over several; the claims
# and headers of those policies have the same ids. An id is shared within ten thousand keys, so the rows
# that have it don't grow with the tables, and few of them keep a header.
_SHARED_ID = "CASE WHEN policy_id LIKE '%7' THEN concat('PX', substr(policy_id, 2, 4)) END"
REPEATED_IDS = {
    "fact_policies": Dirt(repeat="policy_id LIKE '%4'", change={"policy_id": _SHARED_ID}),
    "dim_policies": Dirt(drop="policy_id LIKE '%7' AND policy_id NOT LIKE '%007'", repeat="policy_id LIKE '%5'", change={"policy_id": _SHARED_ID}),
    "fact_claims": Dirt(
        repeat="claim_id LIKE '%3'",
        change={
            "policy_id": _SHARED_ID,
            "claim_id": "CASE WHEN claim_id LIKE '%5' THEN concat('CX', substr(claim_id, 3, 2)) END",
        },
    ),
}

# Tables and columns that are missing.
INCOMPLETE = {
    "clients": Dirt(without=("age", "gender")),
    "policies": Dirt(without=("status",)),
    "claims": Dirt(without=("report_date", "claim_type")),
    "expenses": Dirt(without=("expense_category",)),
    "taxes": Dirt(absent=True),
    "dim_time": Dirt(without=("quarter", "month_name")),
    "dim_state": Dirt(without=("market_tier",)),
    "fact_taxes": Dirt(absent=True),
}

UNSCORED = {"fact_policies": Dirt(clear={"risk_score": "state_code LIKE '%1' AND policy_id NOT LIKE '%4' OR policy_id LIKE '%7'"})}


def dirtied(tables: dict[str, DataFrame], dirt: dict[str, Dirt]) -> dict[str, DataFrame]:
    out = {}
    for name, table in tables.items():
        faults = dirt.get(name, Dirt())
        if faults.absent:
            continue
        kept = table.where(f"NOT coalesce({faults.drop}, false)")
        rows = kept.unionAll(kept.where(faults.repeat))
        types = dict(rows.dtypes)
        changed = {c: F.coalesce(F.expr(value).cast(types[c]), c) for c, value in faults.change.items()}
        changed |= {c: F.when(F.expr(f"NOT coalesce({rows_}, false)"), F.col(c)) for c, rows_ in faults.clear.items()}
        out[name] = (rows.withColumns(changed) if changed else rows).drop(*faults.without)
    return out


def dirty_sql(source: str, faults: Dirt) -> str:
    """The same faults on a table of another engine."""
    changed = [f"coalesce({value}, {c}) AS {c}" for c, value in faults.change.items()]
    changed += [f"CASE WHEN NOT coalesce({rows}, false) THEN {c} END AS {c}" for c, rows in faults.clear.items()]
    columns = "*" if not changed else f"* REPLACE ({', '.join(changed)})"
    columns += f" EXCLUDE ({', '.join(faults.without)})" if faults.without else ""
    kept = f"SELECT * FROM {source} WHERE NOT coalesce({faults.drop}, false)"
    return f"SELECT {columns} FROM ({kept} UNION ALL SELECT * FROM ({kept}) AS k WHERE {faults.repeat}) AS r"

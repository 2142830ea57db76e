"""Typed schemas, keys and column orders of the raw, star and view tables.

Every reader passes one of these schemas; nothing is inferred from data.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "decimal(4,2)": DecimalType(4, 2),
    "decimal(6,4)": DecimalType(6, 4),
    "decimal(18,2)": DecimalType(18, 2),
    "decimal(18,6)": DecimalType(18, 6),
}


def _schema(text: str) -> StructType:
    """Schema of ``name type`` pairs; unlike ``fromDDL`` it needs no running session."""
    words = text.replace(", ", " ").split()
    schema = StructType()
    for name, type_name in zip(words[::2], words[1::2]):
        schema = schema.add(name, TYPES[type_name.rstrip(",")])
    return schema


def _schemas(tables: dict[str, str]) -> dict[str, StructType]:
    return {name: _schema(text) for name, text in tables.items()}


RAW = _schemas(
    {
        "clients": """client_id string, registration_year int, age int, gender string, state_code string,
            region_code string, market_tier string, customer_segment string, max_policies_allowed int""",
        "policies": """policy_id string, policy_number string, client_id string, line_of_business string,
            plan_name string, state_code string, region_code string, effective_date date,
            expiration_date date, status string, is_renewal boolean, risk_score decimal(4,2),
            monthly_premium decimal(18,2), annual_premium decimal(18,2)""",
        "claims": """claim_id string, policy_id string, incident_date date, report_date date,
            claim_type string, claim_amount_requested decimal(18,2), claim_amount_approved decimal(18,2),
            claim_amount_paid decimal(18,2), claim_status string""",
        "expenses": """expense_id bigint, expense_category string, state_code string, region_code string,
            expense_month date, expense_amount decimal(18,2)""",
        "taxes": """tax_id bigint, policy_id string, state_code string, tax_amount decimal(18,2),
            tax_rate decimal(6,4)""",
    }
)

# Columns a raw file may carry on top of its required ones.
RAW_OPTIONAL = _schemas(
    {
        "claims": "fraud_flag string",
        "taxes": "tax_base decimal(18,6)",
    }
)

# Column order is the load order of each warehouse table.
STAR = _schemas(
    {
        "dim_time": """date_key int, full_date date, year int, month int, month_name string, quarter int,
            year_month string, day_of_week int, is_weekend boolean""",
        "dim_state": "state_code string, region_code string, market_tier string",
        "dim_clients": """client_id string, registration_year int, age int, gender string,
            customer_segment string, state_code string, region_code string, market_tier string,
            max_policies_allowed int""",
        "dim_products": "product_key string, line_of_business string, plan_name string",
        "dim_policies": """policy_id string, policy_number string, client_id string, state_code string,
            region_code string, is_renewal boolean""",
        "fact_policies": """policy_id string, product_key string, state_code string, region_code string,
            effective_date_key int, expiration_date_key int, policy_year int, policy_month int,
            status string, risk_score decimal(4,2), monthly_premium decimal(18,2),
            annual_premium decimal(18,2)""",
        "fact_claims": """claim_id string, policy_id string, product_key string, line_of_business string,
            state_code string, region_code string, claim_type string, claim_status string,
            fraud_flag boolean, incident_date_key int, report_date_key int, settlement_date_key int,
            days_to_settle int, claim_amount_requested decimal(18,2),
            claim_amount_approved decimal(18,2), claim_amount_paid decimal(18,2)""",
        "fact_expenses": """expense_id string, expense_category string, state_code string,
            region_code string, date_key int, expense_amount decimal(18,2)""",
        "fact_taxes": """tax_id string, policy_id string, tax_type string, state_code string,
            date_key int, tax_base decimal(18,6), tax_rate decimal(6,4), tax_amount decimal(18,2)""",
    }
)

DIMENSIONS = [name for name in STAR if name.startswith("dim_")]
FACTS = [name for name in STAR if name.startswith("fact_")]
VIEWS = ["exec_portfolio", "claims_loss", "operations_daily", "risk_daily"]

PRIMARY_KEY = {
    "clients": "client_id",
    "policies": "policy_id",
    "claims": "claim_id",
    "expenses": "expense_id",
    "taxes": "tax_id",
    "dim_time": "date_key",
    "dim_state": "state_code",
    "dim_clients": "client_id",
    "dim_products": "product_key",
    "dim_policies": "policy_id",
    "fact_policies": "policy_id",
    "fact_claims": "claim_id",
    "fact_expenses": "expense_id",
    "fact_taxes": "tax_id",
}

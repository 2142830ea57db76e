"""Data-quality contracts: declared rules, one report row per rule, and a gate.

A stage reads each table once per kind of rule, whatever the number of its rules:

* row rules of a table and the metrics of shares share one aggregate, which yields one row;
* key rules (unique, reference) of all tables share one aggregate by (domain, key). A domain is a
  primary key; its own table and every column that refers to it count their keys into it, so no join is
  needed to find keys without a parent. Whole numbers stay numbers, other keys are text; each has its
  own column of the aggregate. Keys are combined on the map side: days, states and products leave a task
  as a few thousand rows however large the facts are, and a key that fills a third of a table as one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coverbay.schemas import PRIMARY_KEY, RAW, STAR, VIEWS
from coverbay.sources.parameters import literal_table
from coverbay.sources.raw import CORRUPT

FAIL, WARN = "FAIL", "WARN"
REPORT = "stage string, table_name string, rule_id string, severity string, violations bigint, passed boolean"


class QualityGateFailed(Exception):
    """At least one FAIL rule is violated."""


@dataclass(frozen=True)
class Columns:
    """The table has all of these columns. Violations: columns missing."""

    table: str
    rule_id: str
    required: tuple[str, ...]
    severity: str = FAIL


@dataclass(frozen=True)
class NotEmpty:
    table: str
    rule_id: str
    severity: str = FAIL


@dataclass(frozen=True)
class Rows:
    """No row satisfies ``bad``, an SQL predicate; a NULL predicate is no violation."""

    table: str
    rule_id: str
    bad: str
    needs: tuple[str, ...]
    severity: str = FAIL


@dataclass(frozen=True)
class Unique:
    """The key occurs once. Violations: further rows of a key; with ``not_null`` also NULL keys."""

    table: str
    rule_id: str
    column: str
    not_null: bool = False
    severity: str = FAIL


@dataclass(frozen=True)
class Reference:
    """Every key exists in the parent.

    ``nulls``: "violate" (a NULL key needs a NULL parent) or "ignore".
    ``count``: "keys" (distinct missing keys) or "rows".
    """

    table: str
    rule_id: str
    column: str
    parent: str
    nulls: str
    count: str
    severity: str = FAIL


@dataclass(frozen=True)
class Share:
    """A ratio of two row metrics stays inside bounds, both included.

    Each metric is (table, SQL aggregate). Violations: 1 outside, also when there is no ratio.
    """

    table: str
    rule_id: str
    numerator: tuple[str, str]
    denominator: tuple[str, str]
    low: float
    high: float
    needs: tuple[str, ...] = ()
    severity: str = WARN


Rule = Columns | NotEmpty | Rows | Unique | Reference | Share


def _needs(rule: Rule) -> tuple[str, ...]:
    if isinstance(rule, (Unique, Reference)):
        return (rule.column,)
    return getattr(rule, "needs", ())


def _runnable(rule: Rule, tables: dict[str, DataFrame]) -> bool:
    if rule.table not in tables or not set(_needs(rule)) <= set(tables[rule.table].columns):
        return False
    if isinstance(rule, Reference):
        return rule.parent in tables and PRIMARY_KEY[rule.parent] in tables[rule.parent].columns
    if isinstance(rule, Share):
        return rule.numerator[0] in tables and rule.denominator[0] in tables
    return True


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    result = None
    for frame in frames:
        result = frame if result is None else result.unionByName(frame)
    return result


def _row_results(rules: list[Rule], tables: dict[str, DataFrame]) -> list[DataFrame]:
    """One aggregate per table for its row rules and the metrics of shares; a few entries meet in the end."""
    measures: dict[str, list[tuple[str, int | None, Column]]] = {}  # table: (rule, side of a share, value)
    whole = set()  # tables of which more is asked than whether there is a row at all
    for rule in rules:
        if isinstance(rule, NotEmpty):
            measures.setdefault(rule.table, []).append((rule.rule_id, None, F.when(F.count("*") > 0, 0).otherwise(1)))
        elif isinstance(rule, Rows):
            measures.setdefault(rule.table, []).append((rule.rule_id, None, F.count(F.when(F.expr(rule.bad), 1))))
            whole.add(rule.table)
        elif isinstance(rule, Share):
            for side, (table, metric) in enumerate([rule.numerator, rule.denominator]):
                measures.setdefault(table, []).append((rule.rule_id, side, F.expr(metric)))
                whole.add(table)
    entries = []
    for table, asked in measures.items():
        rows = tables[table] if table in whole else tables[table].limit(1)
        row = rows.agg(*[value.cast("double" if side is not None else "bigint").alias(f"m{i}") for i, (_, side, value) in enumerate(asked)])
        none = F.lit(None)
        structs = [
            F.struct(
                F.lit(rule_id).alias("rule_id"),
                (F.col(f"m{i}") if side is None else none).cast("bigint").alias("violations"),
                F.lit(side).cast("int").alias("side"),
                (none if side is None else F.col(f"m{i}")).cast("double").alias("metric"),
            )
            for i, (rule_id, side, _) in enumerate(asked)
        ]
        entries.append(row.select(F.inline(F.array(*structs))))
    if not entries:
        return []
    found = _union(entries).groupBy("rule_id").agg(
        F.max("violations").alias("violations"),
        F.max(F.when(F.col("side") == 0, F.col("metric"))).alias("top"),
        F.max(F.when(F.col("side") == 1, F.col("metric"))).alias("bottom"),
    )
    counted = F.col("violations")
    for rule in rules:
        if isinstance(rule, Share):
            inside = F.coalesce(F.try_divide("top", "bottom").between(rule.low, rule.high), F.lit(False))
            counted = F.when(F.col("rule_id") == rule.rule_id, F.when(inside, 0).otherwise(1)).otherwise(counted)
    return [found.select("rule_id", counted.cast("bigint").alias("violations"))]


def _domains(rules: list[Rule]) -> dict[str, list[tuple[str, str]]]:
    """Which column of which table counts into which domain, and in which role (0 is the parent)."""
    unique = [rule.table for rule in rules if isinstance(rule, Unique)]
    references = [rule for rule in rules if isinstance(rule, Reference)]
    roles = {table: [(table, PRIMARY_KEY[table])] for table in dict.fromkeys([*unique, *(rule.parent for rule in references)])}
    for rule in references:
        roles[rule.parent].append((rule.table, rule.column))
    return {domain: list(dict.fromkeys(columns)) for domain, columns in roles.items()}


def _counts(width: int) -> list[Column]:
    return [F.count(F.when(F.col("role") == role, 1)).alias(f"n{role}") for role in range(width)]


def _domain_measures(null: Column, width: int) -> list[Column]:
    """Sums over a domain's keys, of which ``n<role>`` says how often each occurs."""
    known, further = F.col("n0") > 0, F.greatest(F.col("n0") - 1, F.lit(0))
    measures = [F.sum(further).alias("repeated"), F.sum(F.when(null, F.col("n0"))).alias("null_keys")]
    for role in range(1, width):
        count = F.col(f"n{role}")
        missing = (count > 0) & ~known
        measures += [
            F.count(F.when(missing, 1)).alias(f"keys{role}"),
            F.count(F.when(missing & ~null, 1)).alias(f"real_keys{role}"),
            F.sum(F.when(missing, count)).alias(f"rows{role}"),
            F.sum(F.when(missing & ~null, count)).alias(f"real_rows{role}"),
        ]
    return measures


def _domain_rules(rules: list[Rule], domain: str, columns: list[tuple[str, str]]) -> list[tuple[str, Column]]:
    """(rule, violations) in terms of the measures of its domain."""
    results = []
    for rule in rules:
        if isinstance(rule, Unique) and rule.table == domain:
            total = F.col("repeated")
            if rule.not_null:
                # a NULL that occurs once is a violation, further NULLs are already counted
                total = total + F.when(F.coalesce("null_keys", F.lit(0)) > 0, 1).otherwise(0)
            results.append((rule.rule_id, total))
        elif isinstance(rule, Reference) and rule.parent == domain:
            prefix = "real_" if rule.nulls == "ignore" else ""
            results.append((rule.rule_id, F.col(f"{prefix}{rule.count}{columns.index((rule.table, rule.column))}")))
    return results


def _entry(rule_id: str, violations: Column) -> Column:
    return F.struct(F.lit(rule_id).alias("rule_id"), F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"))


def _key_type(tables: dict[str, DataFrame], columns: list[tuple[str, str]]) -> str:
    """The type that all columns of a domain have; text where they differ."""
    kinds = {tables[table].schema[column].dataType.simpleString() for table, column in columns}
    return kinds.pop() if len(kinds) == 1 else "string"


def _key_results(rules: list[Rule], tables: dict[str, DataFrame]) -> list[DataFrame]:
    """One aggregate for every unique and reference rule; a key is a number or a text, the other is NULL."""
    domains = _domains(rules)
    if not domains:
        return []
    number = {domain: i for i, domain in enumerate(domains)}
    kinds = {domain: _key_type(tables, columns) for domain, columns in domains.items()}
    width = max(len(columns) for columns in domains.values())
    keys = []
    for table in dict.fromkeys(table for columns in domains.values() for table, _ in columns):
        entries = []
        for domain, columns in domains.items():
            whole = kinds[domain] in ("tinyint", "smallint", "int", "bigint")
            for role, (of, column) in enumerate(columns):
                if of == table:
                    entries.append(
                        F.struct(
                            F.lit(number[domain]).alias("domain"),
                            F.lit(role).alias("role"),
                            (F.col(column) if whole else F.lit(None)).cast("bigint").alias("number"),
                            (F.lit(None) if whole else F.col(column)).cast("string").alias("text"),
                        )
                    )
        keys.append(tables[table].select(F.inline(F.array(*entries))))
    counted = _union(keys).groupBy("domain", "number", "text").agg(*_counts(width))
    null = F.col("number").isNull() & F.col("text").isNull()
    measured = counted.groupBy("domain").agg(*_domain_measures(null, width))
    entries = [
        F.struct(F.lit(number[domain]).alias("of"), _entry(rule_id, violations).alias("entry"))
        for domain, columns in domains.items()
        for rule_id, violations in _domain_rules(rules, domain, columns)
    ]
    rows = measured.select("domain", F.inline(F.array(*entries))).where(F.col("domain") == F.col("of"))
    return [rows.select("entry.*")]


def run_rules(
    spark: SparkSession,
    stages: dict[str, list[Rule]],
    tables: dict[str, DataFrame],
    presence: dict[str, tuple[str, list[str]]] | None = None,
    found: set[str] | None = None,
) -> DataFrame:
    """One report row per rule of the named stages, which share their passes over the tables.

    Nothing stops early: a rule that cannot run is reported as failed with NULL violations.
    ``presence`` gives, per stage, a rule id and the names expected among ``found``, what storage
    holds, or else among ``tables``.
    """
    rules = [rule for of_stage in stages.values() for rule in of_stage]
    runnable = [rule for rule in rules if _runnable(rule, tables)]
    ran = {rule.rule_id for rule in runnable}
    declared = [
        (stage, rule.table, rule.rule_id, rule.severity, rule.rule_id in ran)
        for stage, of_stage in stages.items()
        for rule in of_stage
    ]
    known = [
        (rule.rule_id, len(set(rule.required) - set(tables[rule.table].columns)))
        for rule in runnable
        if isinstance(rule, Columns)
    ]
    for stage, (rule_id, expected) in (presence or {}).items():
        declared.append((stage, "*", rule_id, FAIL, True))
        known.append((rule_id, len(set(expected) - (set(tables) if found is None else found))))

    frames = _row_results(runnable, tables) + _key_results(runnable, tables)
    if known:
        frames.append(literal_table(spark, "rule_id violations", known))
    declared = literal_table(spark, "stage table_name rule_id severity ran", declared)
    # A rule that ran on a table without rows has no result row: nothing violates it.
    found = F.coalesce("violations", F.when(F.col("ran"), 0).cast("bigint"))
    report = declared.join(_union(frames), "rule_id", "left").withColumn("violations", found)
    return report.select(
        "stage",
        "table_name",
        "rule_id",
        "severity",
        "violations",
        F.coalesce(F.col("violations") == 0, F.lit(False)).alias("passed"),
    )


def enforce(report: DataFrame) -> None:
    """Raise if a FAIL rule did not pass. The report has one row per rule."""
    failed = report.where((F.col("severity") == FAIL) & ~F.col("passed")).orderBy("rule_id").collect()
    if failed:
        raise QualityGateFailed("; ".join(f"{row.rule_id} ({row.violations})" for row in failed))


@dataclass(frozen=True)
class Bounds:
    """Accepted years and dates; the defaults fit the default data window."""

    first_year: int = 2023
    last_year: int = 2025
    first_day: str = "2023-01-01"
    last_day: str = "2025-12-31"


def _outside(column: str, low: str, high: str) -> str:
    return f"NOT coalesce({column} BETWEEN {low} AND {high}, false)"


def raw_rules(bounds: Bounds = Bounds()) -> list[Rule]:
    first, last = f"DATE'{bounds.first_day}'", f"DATE'{bounds.last_day}'"
    before_or_after = "to_date({0}) < " + first + " OR to_date({0}) > " + last
    rules: list[Rule] = [NotEmpty(name, f"V-R2.{name}") for name in RAW]
    rules += [
        Columns(name, rule_id, tuple(RAW[name].names))
        for name, rule_id in [
            ("clients", "V-C1"),
            ("policies", "V-P1"),
            ("claims", "V-K1"),
            ("expenses", "V-E1"),
            ("taxes", "V-T1"),
        ]
    ]
    rules += [
        Unique("clients", "V-C2", "client_id"),
        Unique("policies", "V-P2", "policy_id"),
        Unique("claims", "V-K2", "claim_id"),
        Unique("expenses", "V-E2", "expense_id"),
        Unique("taxes", "V-T2", "tax_id"),
        Reference("policies", "V-P5", "client_id", "clients", "violate", "keys"),
        Reference("claims", "V-K3", "policy_id", "policies", "violate", "keys"),
        Rows("clients", "V-C3", _outside("age", "18", "84"), ("age",)),
        Rows(
            "clients",
            "V-C4",
            _outside("registration_year", str(bounds.first_year), str(bounds.last_year)),
            ("registration_year",),
        ),
        Rows("policies", "V-P3", _outside("risk_score", "1.0", "10.0"), ("risk_score",)),
        Rows("policies", "V-P4", "monthly_premium <= 0", ("monthly_premium",)),
        Rows(
            "policies",
            "V-P6",
            "to_date(effective_date) > to_date(expiration_date)",
            ("effective_date", "expiration_date"),
        ),
        Rows(
            "policies",
            "V-P7",
            f"to_date(effective_date) < {first} OR to_date(expiration_date) > {last}",
            ("effective_date", "expiration_date"),
        ),
        Rows("claims", "V-K4", "claim_amount_requested < 0", ("claim_amount_requested",)),
        Rows(
            "claims",
            "V-K5",
            "claim_amount_paid > claim_amount_approved",
            ("claim_amount_paid", "claim_amount_approved"),
        ),
        Rows("claims", "V-K6", before_or_after.format("incident_date"), ("incident_date",)),
        Rows(
            "claims",
            "V-K7",
            "to_date(report_date) < to_date(incident_date)",
            ("report_date", "incident_date"),
            WARN,
        ),
        Rows("claims", "V-CL6", "policy_id IS NULL", ("policy_id",)),
        Rows("expenses", "V-E3", "expense_amount < 0", ("expense_amount",)),
        Rows("expenses", "V-E4", before_or_after.format("expense_month"), ("expense_month",)),
        Rows("taxes", "V-T3", "tax_amount < 0", ("tax_amount",)),
        Share("claims", "V-S1", ("claims", "count(*)"), ("policies", "count(*)"), 0.10, 0.50),
        Share(
            "policies",
            "V-S2",
            ("policies", "count_if(is_renewal)"),
            ("policies", "count(is_renewal)"),
            0.05,
            0.35,
            ("is_renewal",),
        ),
    ]
    return rules


def star_rules() -> list[Rule]:
    def refers(table, rule_id, column, parent, severity=FAIL, nulls="violate"):
        return Reference(table, rule_id, column, parent, nulls, "keys", severity)

    return [
        *[NotEmpty(name, f"V-N1.{name}") for name in STAR],
        Columns("dim_time", "V-TM1", tuple(STAR["dim_time"].names)),
        Unique("dim_time", "V-TM2", "date_key"),
        Columns("dim_state", "V-ST1", tuple(STAR["dim_state"].names)),
        Unique("dim_state", "V-ST2", "state_code"),
        Unique("dim_clients", "V-DC1", "client_id"),
        refers("dim_clients", "V-DC2", "state_code", "dim_state"),
        Unique("dim_products", "V-PR1", "product_key"),
        Unique("dim_policies", "V-DP1", "policy_id"),
        refers("dim_policies", "V-DP2", "client_id", "dim_clients"),
        refers("dim_policies", "V-DP3", "state_code", "dim_state"),
        refers("fact_policies", "V-FP1", "policy_id", "dim_policies"),
        refers("fact_policies", "V-FP2", "product_key", "dim_products"),
        refers("fact_policies", "V-FP3", "state_code", "dim_state"),
        refers("fact_policies", "V-FP4", "effective_date_key", "dim_time"),
        refers("fact_policies", "V-FP5", "expiration_date_key", "dim_time", WARN),
        refers("fact_claims", "V-CL1", "policy_id", "dim_policies"),
        refers("fact_claims", "V-CL2", "product_key", "dim_products"),
        refers("fact_claims", "V-CL3", "state_code", "dim_state"),
        refers("fact_claims", "V-CL4.incident", "incident_date_key", "dim_time"),
        refers("fact_claims", "V-CL4.report", "report_date_key", "dim_time"),
        refers("fact_claims", "V-CL5", "settlement_date_key", "dim_time", WARN, "ignore"),
        refers("fact_expenses", "V-FE1", "date_key", "dim_time"),
        refers("fact_expenses", "V-FE2", "state_code", "dim_state"),
        Rows("fact_expenses", "V-FE3", "expense_amount < 0", ("expense_amount",)),
        refers("fact_taxes", "V-FT1", "policy_id", "dim_policies"),
        refers("fact_taxes", "V-FT2", "state_code", "dim_state"),
        Rows("fact_taxes", "V-FT3", "tax_amount < 0", ("tax_amount",)),
        Share(
            "fact_claims",
            "V-S3",
            ("fact_claims", "count(*)"),
            ("fact_policies", "greatest(count(*), 1)"),
            0.03,
            0.80,
        ),
    ]


def _rows_reference(table: str, rule_id: str, column: str, parent: str) -> Reference:
    return Reference(table, rule_id, column, parent, "ignore", "rows")


def loaded_rules() -> list[Rule]:
    return [
        *[NotEmpty(name, f"V-L1.{name}") for name in STAR],
        _rows_reference("dim_policies", "V-L2", "client_id", "dim_clients"),
        _rows_reference("fact_policies", "V-L3", "product_key", "dim_products"),
        _rows_reference("fact_policies", "V-L4", "state_code", "dim_state"),
        _rows_reference("fact_policies", "V-L5", "effective_date_key", "dim_time"),
        _rows_reference("fact_claims", "V-L6", "policy_id", "dim_policies"),
        _rows_reference("fact_claims", "V-L7", "product_key", "dim_products"),
        _rows_reference("fact_claims", "V-L8", "state_code", "dim_state"),
        _rows_reference("fact_claims", "V-L9", "incident_date_key", "dim_time"),
    ]


def constraint_rules() -> list[Rule]:
    """Primary and foreign keys a database would enforce, and the calendar the views rely on."""
    return [
        *[Unique(name, f"V-D1.{name}", PRIMARY_KEY[name], not_null=True) for name in STAR],
        Rows(
            "fact_policies",
            "V-D8",
            "policy_year * 100 + policy_month IS DISTINCT FROM effective_date_key DIV 100",
            ("policy_year", "policy_month", "effective_date_key"),
        ),
        _rows_reference("dim_clients", "V-D2", "state_code", "dim_state"),
        _rows_reference("dim_policies", "V-D3", "state_code", "dim_state"),
        _rows_reference("fact_policies", "V-D4", "policy_id", "dim_policies"),
        _rows_reference("fact_claims", "V-D5", "report_date_key", "dim_time"),
        _rows_reference("fact_expenses", "V-D6.state", "state_code", "dim_state"),
        _rows_reference("fact_expenses", "V-D6.date", "date_key", "dim_time"),
        _rows_reference("fact_taxes", "V-D7.state", "state_code", "dim_state"),
        _rows_reference("fact_taxes", "V-D7.date", "date_key", "dim_time"),
    ]


PRESENCE = {
    "raw": ("V-R1", list(RAW)),
    "star": ("V-N1", list(STAR)),
    "loaded": ("V-L11", [*STAR, *VIEWS]),
}


def _present(*stages: str) -> dict[str, tuple[str, list[str]]]:
    return {stage: PRESENCE[stage] for stage in stages}


def check_raw(spark: SparkSession, raw: dict[str, DataFrame], bounds: Bounds = Bounds()) -> DataFrame:
    """Rules of the raw tables; for those read with their unparsable lines, also that there are none."""
    parsed = [
        Rows(name, f"V-R3.{name}", f"{CORRUPT} IS NOT NULL", (CORRUPT,))
        for name, table in raw.items()
        if CORRUPT in table.columns
    ]
    return run_rules(spark, {"raw": [*raw_rules(bounds), *parsed]}, raw, _present("raw"))


def check_star(spark: SparkSession, star: dict[str, DataFrame]) -> DataFrame:
    return run_rules(spark, {"star": star_rules()}, star, _present("star"))


def check_constraints(spark: SparkSession, star: dict[str, DataFrame]) -> DataFrame:
    return run_rules(spark, {"ddl": constraint_rules()}, star)


def check_loaded(
    spark: SparkSession, star: dict[str, DataFrame], views: dict[str, DataFrame]
) -> DataFrame:
    """Loaded tables and views. A view is run for one row; an empty view warns, a failing one fails."""
    report = run_rules(spark, {"loaded": loaded_rules()}, {**star, **views}, _present("loaded"))
    return report.unionByName(_view_probes(spark, views))


def check_tables(spark: SparkSession, star: dict[str, DataFrame]) -> DataFrame:
    """Star, key-constraint and loaded stages of the nine tables in one go."""
    stages = {"star": star_rules(), "ddl": constraint_rules(), "loaded": loaded_rules()}
    return run_rules(spark, stages, star, _present("star"))


def check_views(
    spark: SparkSession, star: dict[str, DataFrame], views: dict[str, DataFrame], found: set[str] | None = None
) -> DataFrame:
    """The part of the loaded stage that needs the views; ``found`` names what storage holds."""
    present = run_rules(spark, {"loaded": []}, {**star, **views}, _present("loaded"), found)
    return present.unionByName(_view_probes(spark, views))


def _view_probes(spark: SparkSession, views: dict[str, DataFrame]) -> DataFrame:
    """A row per view. A view that fails is a violated FAIL rule, not the end of the report."""
    rows = []
    for name, view in views.items():
        try:
            empty, severity = int(not view.take(1)), WARN  # a row with all its columns
        except PySparkException:
            empty, severity = None, FAIL
        rows.append(("loaded", name, f"V-L10.{name}", severity, empty, empty == 0))
    return spark.createDataFrame(rows, REPORT)

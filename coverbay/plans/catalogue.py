"""Every query by name, each over the test tables of a scale-factor folder.

Nothing is kept between queries: each one lists the folder, fetches the first and last day of the
calendar where a view needs them, and reads the Parquet tables again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from coverbay import standin
from coverbay.dirt import INCOMPLETE, RAW_DIRT, REPEATED_IDS, STAR_DIRT, UNSCORED, dirtied
from coverbay.functions.text import tolerant_flag
from coverbay.operators import derive, quality, star as builders
from coverbay.operators.inforce import Calendar
from coverbay.plans import dashboards, views
from coverbay.sources.raw import row_counts
from coverbay.sources.staging import result, staging

Query = Callable[[SparkSession, str], DataFrame]

SLICE = {"line_of_business": "Auto", "region_code": "ASIA", "state_code": "NATION_2"}
SLICE_YEAR = 1998
TOP_STATES = 5
POOL_YEAR = 1999
FIRST_YEAR, LAST_YEAR = standin.YEARS
BOUNDS = quality.Bounds(FIRST_YEAR, LAST_YEAR, *standin.WINDOW)


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that other engines' results compare value by value."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else f.name
            for f in df.schema
        ]
    )


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return standin.raw_tables(spark, sf_dir)


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return builders.build_star(_raw(spark, sf_dir))


def _calendar(spark: SparkSession, sf_dir: str) -> Calendar:
    return Calendar.of(_star(spark, sf_dir)["dim_time"])


def _table(name: str) -> Query:
    return lambda spark, sf_dir: _star(spark, sf_dir)[name]


def _view(build) -> Query:
    return lambda spark, sf_dir: build(_star(spark, sf_dir), _calendar(spark, sf_dir))


def _dashboard(view, query) -> Query:
    return lambda spark, sf_dir: query(_view(view)(spark, sf_dir))


def _repeated_view(build) -> Query:
    """The view where policy and claim ids repeat, over the same calendar."""
    return lambda spark, sf_dir: build(dirtied(_star(spark, sf_dir), REPEATED_IDS), _calendar(spark, sf_dir))


def _repeated_claims(build) -> Query:
    """Claim metrics where policy and claim ids repeat; raw tables and facts are staged, each job reads them again."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with staging(spark) as stage:
            with staging(spark) as stage_raw:
                clean = builders.build_star(standin.raw_tables(spark, sf_dir, stage_raw))
                calendar = Calendar.of(clean["dim_time"])
                star = dirtied(clean, REPEATED_IDS)
                used = ["dim_products", "fact_policies", "fact_claims"]
                facts = {name: stage(star[name].select(views.CLAIM_COLUMNS.get(name, "*"))) for name in used}
            return result(build(facts, calendar))

    return run


def _claims_over(by: list[str], grain: str) -> Query:
    return _view(lambda star, calendar: views.claims_over(star, by, grain, calendar))


def risk_dashboard_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk dashboard where many policies of some segments have no score."""
    star = dirtied(_star(spark, sf_dir), UNSCORED)
    return dashboards.risk_by_day(views.risk_states(star, _calendar(spark, sf_dir)))


def kpi_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = dashboards.yearly_kpis(_view(views.exec_portfolio)(spark, sf_dir))
    metrics = [name for name in yearly.columns if name != "year"]
    return dashboards.change_on_prior_year(yearly, metrics)


def slice_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_year = _calendar(spark, sf_dir).of_year(SLICE_YEAR)
    return views.operations_daily(_star(spark, sf_dir), of_year)


def quality_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_raw(spark, _raw(spark, sf_dir), BOUNDS)


def quality_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_star(spark, _star(spark, sf_dir))


def _complete(spark: SparkSession, report: DataFrame) -> DataFrame:
    """A report's rows, one per rule, so that it outlives the staged tables it was made of."""
    return spark.createDataFrame(report.collect(), report.schema)


def quality_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    with staging(spark) as stage:
        star = builders.build_star(standin.raw_tables(spark, sf_dir, stage))
        built = views.build_views(star, Calendar.of(star["dim_time"]))
        return _complete(spark, quality.check_loaded(spark, star, built))


def quality_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_constraints(spark, _star(spark, sf_dir))


def quality_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw, star, loaded and constraint rules over tables with faults of every kind."""
    with staging(spark) as stage:
        raw = standin.raw_tables(spark, sf_dir, stage)
        # one after the other: the first report's shuffle files are gone before the second's are written
        found = _complete(spark, quality.check_raw(spark, dirtied(raw, RAW_DIRT), BOUNDS))
        star = dirtied(builders.build_star(raw), STAR_DIRT)
        return found.union(_complete(spark, quality.check_tables(spark, star)))


def quality_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw and star rules where tables and columns are missing."""
    raw = quality.check_raw(spark, dirtied(_raw(spark, sf_dir), INCOMPLETE), BOUNDS)
    return raw.union(quality.check_star(spark, dirtied(_star(spark, sf_dir), INCOMPLETE)))


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return row_counts({**raw, **builders.build_star(raw)})


def fraud_flag_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _raw(spark, sf_dir)["claims"]
    flag = F.col("fraud_flag")
    return claims.groupBy(flag.alias("flag_text"), tolerant_flag(flag).alias("is_fraud")).agg(
        F.count("*").alias("claims")
    )


def policy_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = _raw(spark, sf_dir)["policies"]
    end = derive.policy_end(F.col("effective_date"), F.lit(standin.END).cast("date"))
    return policies.select("policy_id", "effective_date", end.alias("term_end"))


def renewal_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    registered = raw["clients"].select("client_id", "registration_year")
    # a client's policies of a year are one row before they meet the client
    held = raw["policies"].groupBy("client_id", F.year("effective_date").alias("policy_year"))
    joined = held.agg(F.count("*").alias("held")).join(registered, "client_id", "left")
    renewed = derive.is_renewal(F.col("registration_year"), F.col("policy_year"))
    return joined.groupBy("policy_year", "registration_year").agg(
        F.sum(F.when(renewed, F.col("held")).otherwise(0)).alias("renewals"),
        F.sum("held").alias("policies"),
    )


def plan_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = _raw(spark, sf_dir)["policies"].drop("monthly_premium", "annual_premium")
    priced = derive.plan_premium(policies, standin.parameters(spark, sf_dir).plans)
    return priced.select("policy_id", "monthly_premium", "annual_premium")


def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = _raw(spark, sf_dir)["clients"]
    score = derive.risk_score(F.col("age"), F.col("customer_segment"), F.lit(0).cast("decimal(4,2)"))
    return clients.select("client_id", "age", "customer_segment", score.alias("risk_score"))


def client_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.client_years(_raw(spark, sf_dir)["clients"], LAST_YEAR)


def remaining_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return derive.remaining_capacity(raw["clients"], raw["policies"], LAST_YEAR)


def capacity_shortfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return derive.capacity_shortfall(raw["clients"], raw["policies"], LAST_YEAR)


def capacity_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return derive.capacity_pool(raw["clients"], raw["policies"], POOL_YEAR)


def exposure_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    exposed = derive.exposure(_raw(spark, sf_dir)["policies"], F.lit(standin.END).cast("date"))
    return exposed.select("policy_id", "exposure_days", "year_fraction")


def expected_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = _raw(spark, sf_dir)["policies"]
    return derive.expected_claims(policies, standin.parameters(spark, sf_dir), F.lit(standin.END).cast("date"))


def actual_vs_expected_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    end = F.lit(standin.END).cast("date")
    return derive.actual_vs_expected(raw["policies"], raw["claims"], standin.parameters(spark, sf_dir), end)


def report_date_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _raw(spark, sf_dir)["claims"]
    capped = derive.report_date(F.col("incident_date"), F.lit(30), F.lit(standin.END).cast("date"))
    return claims.select("claim_id", "incident_date", capped.alias("latest_report"))


def settlement_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = _raw(spark, sf_dir)["claims"]
    settled = derive.settlement_amounts(claims, F.col("claim_amount_requested"))
    return settled.groupBy("claim_status").agg(
        F.count("*").alias("claims"),
        F.sum("claim_amount_approved").alias("approved"),
        F.sum("claim_amount_paid").alias("paid"),
    )


def premium_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    parameters = standin.parameters(spark, sf_dir)
    tiers = parameters.states.select("state_code", "market_tier")
    policies = _raw(spark, sf_dir)["policies"].join(tiers, "state_code", "left")
    taxed = derive.premium_tax(policies, parameters.tax_rates)
    return taxed.select("policy_id", "market_tier", "tax_rate", "premium_tax")


def expense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = standin.parameters(spark, sf_dir).states
    return derive.expense_grid(_raw(spark, sf_dir)["expenses"], states, *standin.WINDOW)


def yearly_new_from_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients, by = _raw(spark, sf_dir)["clients"], ["region_code"]
    stock = derive.yearly_stock(clients, "registration_year", FIRST_YEAR, LAST_YEAR, by)
    return derive.yearly_new_from_stock(stock, by)


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = standin.parameters(spark, sf_dir).states
    policies = _raw(spark, sf_dir)["policies"].select("policy_id", "state_code")
    return derive.state_lookup(policies, states)


def portfolio_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    parameters = standin.parameters(spark, sf_dir)
    return derive.portfolio_targets(
        _raw(spark, sf_dir)["clients"],
        [LAST_YEAR - 1, LAST_YEAR],
        ["region_code"],
        parameters.growth_rate,
        parameters.policies_per_client,
    )


def seasonal_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    policies = builders.build_fact_policies(_raw(spark, sf_dir)["policies"])
    yearly = policies.groupBy("policy_year", "product_key").agg(F.count("*").alias("new_policies"))
    weights = standin.parameters(spark, sf_dir).new_business_weights
    return derive.seasonal_allocation(yearly, "new_policies", list(weights))


QUERIES: dict[str, Query] = {
    **{
        name: _table(name)
        for name in (
            "dim_time",
            "dim_state",
            "dim_clients",
            "dim_products",
            "dim_policies",
            "fact_policies",
            "fact_claims",
            "fact_expenses",
            "fact_taxes",
        )
    },
    "exec_portfolio": _view(views.exec_portfolio),
    "claims_loss": _view(views.claims_loss),
    "operations_daily": _view(views.operations_daily),
    "risk_daily": _view(views.risk_daily),
    **{f"{name}_repeated_ids": _repeated_view(build) for name, build in views.BUILDERS.items()},
    "claims_loss_repeated_ids": _repeated_claims(views.claims_loss),
    "exec_portfolio_month_once": _view(views.exec_portfolio_month_once),
    "claims_loss_true_exposure": _view(views.claims_loss_true_exposure),
    "operations_daily_equivalent": _view(views.operations_daily_equivalent),
    "risk_daily_threshold": _view(views.risk_daily_threshold),
    "kpi_avg_monthly_active": _dashboard(views.exec_portfolio, dashboards.avg_monthly_active),
    "kpi_total_annual_premium": _dashboard(views.exec_portfolio, dashboards.total_annual_premium),
    "kpi_total_monthly_premium": _dashboard(views.exec_portfolio, dashboards.total_monthly_premium),
    "kpi_avg_premium_per_policy": _dashboard(views.exec_portfolio, dashboards.avg_premium_per_policy),
    "kpi_yoy": kpi_yoy,
    "new_policies_by_month_lob": _dashboard(
        views.operations_daily, dashboards.new_policies_by_month_line
    ),
    "premium_exposure_by_month_lob": _dashboard(
        views.exec_portfolio, dashboards.premium_exposure_by_month_line
    ),
    "premium_by_state_lob": _dashboard(views.exec_portfolio, dashboards.premium_by_state_line),
    "top_states_by_premium": _dashboard(
        views.exec_portfolio, lambda view: dashboards.premium_by_state_line(view, TOP_STATES)
    ),
    "slice_lob_region_state": _dashboard(
        views.exec_portfolio, lambda view: dashboards.slice_view(view, **SLICE)
    ),
    "slice_year": slice_year,
    "claims_dashboard_rollup": _dashboard(
        views.claims_loss, lambda view: dashboards.claims_rollup(view, ["line_of_business"])
    ),
    "claims_dashboard_by_state": _dashboard(
        views.claims_loss, lambda view: dashboards.claims_rollup(view, ["state_code"])
    ),
    "operations_dashboard": _dashboard(views.operations_daily, dashboards.operations_by_day),
    "risk_dashboard": _dashboard(views.risk_states, dashboards.risk_by_day),
    "risk_dashboard_unscored": risk_dashboard_unscored,
    "claims_by_quarter": _claims_over(["line_of_business"], "quarter"),
    "claims_by_year": _claims_over(["state_code", "line_of_business"], "year"),
    "claims_by_year_repeated_ids": _repeated_claims(
        lambda star, calendar: views.claims_over(star, ["line_of_business"], "year", calendar)
    ),
    "quality_raw": quality_raw,
    "quality_star": quality_star,
    "quality_loaded": quality_loaded,
    "quality_ddl": quality_ddl,
    "quality_dirty": quality_dirty,
    "quality_incomplete": quality_incomplete,
    "row_counts": table_row_counts,
    "fraud_flag_parse": fraud_flag_parse,
    "policy_term": policy_term,
    "renewal_flag": renewal_flag,
    "plan_premium": plan_premium,
    "risk_score": risk_score,
    "client_capacity": client_capacity,
    "remaining_capacity": remaining_capacity,
    "capacity_shortfall": capacity_shortfall,
    "capacity_pool": capacity_pool,
    "exposure_days": exposure_days,
    "expected_claims": expected_claims,
    "actual_vs_expected_claims": actual_vs_expected_claims,
    "report_date_cap": report_date_cap,
    "settlement_amounts": settlement_amounts,
    "premium_tax": premium_tax,
    "expense_grid": expense_grid,
    "yearly_new_from_stock": yearly_new_from_stock,
    "state_lookup": state_lookup,
    "portfolio_targets": portfolio_targets,
    "seasonal_allocation": seasonal_allocation,
}


def query(name: str) -> Query:
    return lambda spark, sf_dir: shown(QUERIES[name](spark, sf_dir))

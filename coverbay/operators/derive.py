"""Insurance derivations: deterministic business rules as column and table operators."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.functions.dates import days_inclusive
from coverbay.functions.numbers import clip, money_round
from coverbay.sources.parameters import GROWTH_RATE, POLICIES_PER_CLIENT, Parameters

# Fixed values of the rules below.
TERM_DAYS = 364
DAYS_PER_YEAR = 365
BASE_SCORE = "5.0"
AGE_LOADING_BELOW = [(26, "1.5"), (36, "0.5")]
AGE_LOADING_ABOVE = [(65, "2.5"), (50, "1.0")]
CORPORATE_DISCOUNT = "0.3"
CAPACITY_GROWTH_LIMIT = 2
RELAX_ROUNDS_LIMIT = 3
LOWEST_MONTH_WEIGHT = "0.02"

SCORE = "decimal(4,2)"


def _decimal(text: str, type_name: str = "decimal(4,2)") -> Column:
    return F.lit(text).cast(type_name)


def policy_end(effective: Column, window_end: Column) -> Column:
    """Last day of a one-year term, cut at the end of the window; NULL without a start."""
    return F.when(effective.isNotNull(), F.least(F.date_add(effective, TERM_DAYS), window_end))


def is_renewal(registration_year: Column, policy_year: Column) -> Column:
    return registration_year < policy_year


def plan_premium(policies: DataFrame, plans: DataFrame) -> DataFrame:
    """Monthly and annual premium from the plan's base price; NULL for an unknown plan."""
    priced = policies.join(plans, ["line_of_business", "plan_name"], "left")
    monthly = F.col("base_monthly_premium")
    return priced.withColumns(
        {
            "monthly_premium": money_round(monthly),
            "annual_premium": money_round(monthly * 12),
        }
    ).drop("base_monthly_premium")


def base_risk_score(age: Column, segment: Column) -> Column:
    """Score before individual deviation; the first matching age band counts."""
    loading = F.lit(None).cast(SCORE)
    bands = [(age < limit, add) for limit, add in AGE_LOADING_BELOW]
    bands += [(age > limit, add) for limit, add in AGE_LOADING_ABOVE]
    (condition, add), *others = bands
    loading = F.when(condition, _decimal(add))
    for condition, add in others:
        loading = loading.when(condition, _decimal(add))
    corporate = F.when(segment == "Corporate", _decimal(CORPORATE_DISCOUNT)).otherwise(_decimal("0"))
    return _decimal(BASE_SCORE) + loading.otherwise(_decimal("0")) - corporate


def risk_score(age: Column, segment: Column, deviation: Column) -> Column:
    """Base score plus a deviation, two places, between 1 and 10."""
    score = F.bround(base_risk_score(age, segment) + deviation, 2)
    return clip(score, _decimal("1"), _decimal("10")).cast(SCORE)


def client_capacity(registration_year: Column, base_capacity: Column, year: Column) -> Column:
    """Policies a client may hold in a year; grows after the year of registration."""
    growth = F.least(F.lit(CAPACITY_GROWTH_LIMIT), year - registration_year)
    return base_capacity + F.when(year > registration_year, growth).otherwise(0)


def client_years(clients: DataFrame, last_year: int) -> DataFrame:
    """One row per client and year from registration to ``last_year``, with its capacity."""
    registered, base = F.col("registration_year"), F.col("max_policies_allowed")
    years = clients.where(registered <= last_year).withColumn(
        "year", F.explode(F.sequence(registered, F.lit(last_year)))
    )
    return years.select(
        "client_id",
        "registration_year",
        "max_policies_allowed",
        "year",
        client_capacity(registered, base, F.col("year")).alias("capacity"),
    )


def remaining_capacity(clients: DataFrame, policies: DataFrame, last_year: int) -> DataFrame:
    """Capacity of each client and year less the policies taken out in earlier years.

    Capacities and policies meet in one aggregate by client and year, combined on the map side: a
    client with very many policies is a handful of rows per task, and one per year afterwards.
    """
    capacities = client_years(clients, last_year).select(
        "client_id", "year", "capacity", F.lit(0).alias("taken")
    )
    taken = policies.select(
        "client_id",
        F.year("effective_date").alias("year"),
        F.lit(None).cast("int").alias("capacity"),
        F.lit(1).alias("taken"),
    )
    by_year = (
        capacities.unionByName(taken)
        .groupBy("client_id", "year")
        .agg(F.max("capacity").alias("capacity"), F.sum("taken").alias("taken"))
    )
    earlier = (
        Window.partitionBy("client_id")
        .orderBy("year")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    )
    held = F.coalesce(F.sum("taken").over(earlier), F.lit(0))
    with_held = by_year.withColumn("held", held).where(F.col("capacity").isNotNull())
    return with_held.select(
        "client_id", "year", "capacity", "held", (F.col("capacity") - F.col("held")).alias("remaining")
    )


def capacity_shortfall(clients: DataFrame, policies: DataFrame, last_year: int) -> DataFrame:
    """Per year: remaining capacity against new policies, and the relaxation a shortfall needs.

    One round of relaxation gives every eligible client one more policy; needing more rounds than
    the limit is a failure, and so is a shortfall in a year without any eligible client, whose
    rounds are NULL. Years of either side are kept, a missing year too.
    """
    supply = (
        remaining_capacity(clients, policies, last_year)
        .groupBy("year")
        .agg(F.count("*").alias("eligible_clients"), F.sum("remaining").alias("remaining_capacity"))
    )
    demand = policies.groupBy(F.year("effective_date").alias("year")).agg(
        F.count("*").alias("new_policies")
    )
    counts = ["eligible_clients", "remaining_capacity", "new_policies"]
    joined = supply.join(demand, "year", "full").fillna(0, counts)
    missing = F.greatest(F.col("new_policies") - F.col("remaining_capacity"), F.lit(0))
    rounds = F.ceil(F.try_divide(missing, F.col("eligible_clients")))
    unsolved = rounds.isNull() | (rounds > RELAX_ROUNDS_LIMIT)
    return joined.withColumns(
        {
            "shortfall": missing > 0,
            "relax_rounds": rounds,
            "capacity_failure": (missing > 0) & unsolved,
        }
    )


def capacity_pool(clients: DataFrame, policies: DataFrame, year: int) -> DataFrame:
    """One row per policy a client may still take out in ``year``.

    In a year of shortfall every eligible client's capacity is first raised by the rounds of
    relaxation that the year needs, as far as the limit allows.
    """
    of_year = remaining_capacity(clients, policies, year).where(F.col("year") == year)
    needed = capacity_shortfall(clients, policies, year).where(F.col("year") == year)
    raised = needed.select(
        F.least(F.coalesce("relax_rounds", F.lit(0)), F.lit(RELAX_ROUNDS_LIMIT)).alias("raise")
    )
    more = F.coalesce(raised.scalar(), F.lit(0))  # one row, or none without clients
    open_slots = of_year.withColumn("remaining", F.col("remaining") + more)
    slots = F.explode(F.sequence(F.lit(1), F.col("remaining").cast("int")))
    return open_slots.where("remaining > 0").select("client_id", slots.alias("slot"))


def exposure(policies: DataFrame, window_end: Column) -> DataFrame:
    """Days in force, both ends included, and the fraction of a year.

    An open-ended policy is in force to the end of the window. Terms that end before they start,
    and policies without a start, are in force on no day and drop out.
    """
    effective = F.col("effective_date")
    expiration = F.coalesce("expiration_date", window_end)
    days = days_inclusive(effective, expiration)
    return policies.where(effective <= expiration).withColumns(
        {
            "exposure_days": days,
            "year_fraction": days.cast("double") / F.lit(float(DAYS_PER_YEAR)),
        }
    )


def _claim_factors(policies: DataFrame, parameters: Parameters, window_end: Column) -> DataFrame:
    """Yearly frequency x seasonality x climate x exposure days, exactly, as ``factor_days``.

    NULL for a line or month that the parameters don't list.
    """
    with_month = exposure(policies, window_end).withColumn("month", F.month("effective_date"))
    joined = (
        with_month.join(parameters.baseline, "line_of_business", "left")
        .join(parameters.seasonality, "month", "left")
        .join(parameters.climate, "state_code", "left")
    )
    climate = F.coalesce("climate", _decimal(parameters.default_climate, "decimal(6,4)"))
    factor = F.col("baseline_frequency") * F.col("seasonality") * climate
    return joined.withColumn("factor_days", (factor * F.col("exposure_days")).cast("decimal(28,12)"))


def _per_year(factor_days: Column) -> Column:
    years = factor_days.cast("double") / F.lit(float(DAYS_PER_YEAR))
    return F.when(years.isNotNull(), F.greatest(years, F.lit(0.0)))


def expected_claims(policies: DataFrame, parameters: Parameters, window_end: Column) -> DataFrame:
    """Expected claims of each policy over its term, never below zero; NULL if a factor is unknown."""
    return _claim_factors(policies, parameters, window_end).select(
        "policy_id",
        "line_of_business",
        "state_code",
        "exposure_days",
        "year_fraction",
        _per_year(F.col("factor_days")).alias("expected_claims"),
    )


def actual_vs_expected(
    policies: DataFrame, claims: DataFrame, parameters: Parameters, window_end: Column
) -> DataFrame:
    """Claims counted against claims expected per line of business and state.

    Both sides cover the same policies: those exposed, with all factors known. Exposed policies
    with an unknown factor are counted apart, and their claims left out. Claims are counted per
    policy first, on the map side, so a policy with very many of them is one row when it meets its
    policy. Expected claims are summed as exact decimals, in any order.
    """
    counted = claims.groupBy("policy_id").agg(F.count("*").alias("claims"))
    exposed = _claim_factors(policies, parameters, window_end).join(counted, "policy_id", "left")
    known = F.col("factor_days").isNotNull()
    sums = exposed.groupBy("line_of_business", "state_code").agg(
        F.count_if(known).alias("policies"),
        F.count_if(~known).alias("unknown_factor_policies"),
        F.coalesce(F.sum(F.when(known, F.col("claims"))), F.lit(0)).alias("actual_claims"),
        _per_year(F.sum("factor_days")).alias("expected_claims"),
    )
    ratio = F.try_divide(F.col("actual_claims").cast("double"), F.col("expected_claims"))
    return sums.withColumn("actual_to_expected", ratio)


def report_date(incident: Column, delay_days: Column, window_end: Column) -> Column:
    """Incident plus a reporting delay, cut at the end of the window; NULL without either."""
    reported = F.date_add(incident, delay_days)
    return F.when(reported.isNotNull(), F.least(reported, window_end))


def settlement_amounts(claims: DataFrame, offered: Column) -> DataFrame:
    """Approved and paid amounts from the claim's status and the amount offered for it."""
    status = F.col("claim_status")
    nothing = F.lit(0).cast("decimal(18,2)")
    approved = F.when(status == "Denied", nothing).otherwise(offered)
    return claims.withColumns(
        {
            "claim_amount_approved": approved,
            "claim_amount_paid": F.when(status == "Paid", approved).otherwise(nothing),
        }
    )


def premium_tax(policies: DataFrame, tax_rates: DataFrame, rate_factor: Column | None = None) -> DataFrame:
    """Premium tax by market tier. Rate is shown to four places, the tax uses it unrounded."""
    rate = F.col("tier_rate")
    if rate_factor is not None:
        rate = rate * rate_factor
    taxed = policies.join(tax_rates, "market_tier", "left")
    return taxed.withColumns(
        {
            "premium_tax": money_round(F.col("annual_premium") * rate),
            "tax_rate": F.bround(rate, 4).cast("decimal(6,4)"),
        }
    ).drop("tier_rate")


def expense_grid(expenses: DataFrame, states: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Every month of the window for every state, with the actual expenses or zero."""
    months = F.sequence(
        F.trunc(F.lit(first_day).cast("date"), "month"),
        F.trunc(F.lit(last_day).cast("date"), "month"),
        F.expr("interval 1 month"),
    )
    grid = states.select(
        "state_code", "region_code", "market_tier", F.explode(months).alias("expense_month")
    )
    actual = expenses.groupBy("state_code", F.trunc("expense_month", "month").alias("expense_month")).agg(
        F.sum("expense_amount").alias("expense_amount")
    )
    return grid.join(actual, ["state_code", "expense_month"], "left").withColumn(
        "expense_amount", F.coalesce("expense_amount", F.lit(0).cast("decimal(28,2)"))
    )


def yearly_stock(df: DataFrame, year: str, first_year: int, last_year: int, by: list[str]) -> DataFrame:
    """Rows that exist in each year, counting every row from its first year on.

    ``by`` must be columns of low cardinality: the years of a group are summed in one window.
    """
    added = df.groupBy(*by, F.greatest(F.col(year), F.lit(first_year)).alias("year")).agg(
        F.count("*").alias("added")
    )
    years = added.select(*by).distinct().withColumn(
        "year", F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    )
    same = [years[c].eqNullSafe(added[c]) for c in [*by, "year"]]
    grid = years.join(added, on=reduce(lambda a, b: a & b, same), how="left").select(
        *[years[c] for c in [*by, "year"]], "added"
    )
    so_far = Window.partitionBy(*by).orderBy("year")
    return grid.select(*by, "year", F.coalesce(F.sum("added").over(so_far), F.lit(0)).alias("stock"))


def yearly_new_from_stock(stock: DataFrame, by: list[str]) -> DataFrame:
    """Yearly change of a stock: the first year's stock, then differences.

    ``is_skipped`` marks changes that add nothing and ``is_falling`` those that would need rows
    to leave.
    """
    previous = F.lag("stock").over(Window.partitionBy(*by).orderBy("year"))
    new = F.col("stock") - F.coalesce(previous, F.lit(0))
    return stock.withColumn("new", new).withColumns(
        {"is_skipped": F.col("new") <= 0, "is_falling": F.col("new") < 0}
    )


def state_lookup(df: DataFrame, states: DataFrame) -> DataFrame:
    """Region and market tier of each row's state; NULL for an unknown state."""
    looked_up = states.select(
        "state_code",
        F.col("region_code").alias("state_region"),
        F.col("market_tier").alias("state_tier"),
    )
    return df.join(looked_up, "state_code", "left")


def portfolio_targets(
    clients: DataFrame,
    years: list[int],
    by: list[str],
    growth_rate: float = GROWTH_RATE,
    policies_per_client: float = POLICIES_PER_CLIENT,
) -> DataFrame:
    """Target clients and policies per year: all clients in the last year, less growth before it."""
    total = clients.groupBy(*by).agg(F.count("*").alias("total_clients"))
    last = max(years)
    rows = total.withColumn("year", F.explode(F.array(*[F.lit(y) for y in sorted(years)])))
    shrink = F.pow(F.lit(1 + growth_rate), (F.lit(last) - F.col("year")).cast("double"))
    active = F.floor(F.col("total_clients").cast("double") / shrink)
    return rows.withColumn("active_clients", active).withColumn(
        "estimated_policies", F.floor(F.col("active_clients") * F.lit(policies_per_client))
    )


def seasonal_allocation(yearly: DataFrame, total: str, weights: list[str]) -> DataFrame:
    """Split each row's yearly total over the months by weights made to sum to one."""
    raised = [max(Decimal(weight), Decimal(LOWEST_MONTH_WEIGHT)) for weight in weights]
    shares = F.array(*[F.lit(float(weight)) / F.lit(float(sum(raised))) for weight in raised])
    spread = yearly.select("*", F.posexplode(shares).alias("month_index", "weight"))
    return spread.select(
        *yearly.columns,
        (F.col("month_index") + 1).alias("month"),
        "weight",
        (F.col(total).cast("double") * F.col("weight")).alias("expected_new"),
    )

"""The four semantic views over the star schema, and their documented-intent variants.

Facts are aggregated on their own columns first. Dimensions meet only the aggregated rows, so no
fact row is shuffled on a handful of product or date keys and no join needs a hint.

Policies and claims are counted by their ids. Each builder takes ``distinct``: False where the ids of
the policy tables and of the claims are known to be unique, as after a load whose rules have passed, so
that rows may be counted; True where they may repeat; None, the default, looks by one aggregate over
the ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.functions.dates import key_date, month_start
from coverbay.functions.numbers import ratio
from coverbay.operators.inforce import (
    PER_DAY,
    PER_POLICY,
    Calendar,
    InForceSum,
    calendar_columns,
    ids_are_unique,
    in_force,
)
from coverbay.operators.skew import salted_join

from coverbay.schemas import PRIMARY_KEY

Star = dict[str, DataFrame]

CONTRACT_RISK_THRESHOLD = 0.8
SCORE_SCALE_THRESHOLD = 7.0
MONEY = "decimal(38,2)"

GEOGRAPHY = ["state_code", "region_code"]
LINE_SEGMENT = [*GEOGRAPHY, "line_of_business"]


def _month_columns() -> list[Column]:
    period = F.col("period")
    return [period.alias("month_date"), *calendar_columns(period)]


def _day_columns() -> list[Column]:
    day = F.col("period")
    return [day.alias("day_date"), *calendar_columns(day)]


def _with_line(star: Star):
    """Left join of aggregated rows to their line of business; unknown products keep a NULL line."""
    lines = star["dim_products"].select("product_key", "line_of_business")
    return lambda rows: rows.join(lines, "product_key", "left")


def _calendar(star: Star, calendar: Calendar | None) -> Calendar:
    return calendar or Calendar.of(star["dim_time"])


def _repeats(star: Star, distinct: bool | None, *tables: str) -> bool:
    """Whether ids of these tables may repeat."""
    if distinct is None:
        return not all(ids_are_unique(star[name], PRIMARY_KEY[name]) for name in tables)
    return distinct


def _line_in_force(
    star: Star, calendar: Calendar, policies: DataFrame, sums, *, grain: str, null_expiration: str, distinct: bool
) -> DataFrame:
    return in_force(
        policies,
        calendar,
        ["product_key", *GEOGRAPHY],
        sums,
        grain=grain,
        null_expiration=null_expiration,
        regroup=_with_line(star),
        keep=LINE_SEGMENT,
        distinct=distinct,
    )


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY).alias(name)


def _portfolio(star: Star, calendar: Calendar | None, per: str, distinct: bool | None) -> DataFrame:
    repeats = _repeats(star, distinct, "fact_policies")
    calendar = _calendar(star, calendar)
    sums = [
        InForceSum("total_annual_premium", F.col("annual_premium"), per, null_if_empty=True),
        InForceSum("total_monthly_premium", F.col("monthly_premium"), per, null_if_empty=True),
    ]
    rows = _line_in_force(
        star, calendar, star["fact_policies"], sums, grain="month", null_expiration="single_day", distinct=repeats
    )
    return rows.select(
        *_month_columns(),
        "active_policies",
        _money("total_annual_premium"),
        _money("total_monthly_premium"),
        *LINE_SEGMENT,
    )


def exec_portfolio(star: Star, calendar: Calendar | None = None, distinct: bool | None = None) -> DataFrame:
    """Policies and premium per month, state, region and line.

    A premium counts once for every day of the month its policy is in force. A policy without an
    expiration is in force on its first day only.
    """
    return _portfolio(star, calendar, PER_DAY, distinct)


def exec_portfolio_month_once(
    star: Star, calendar: Calendar | None = None, distinct: bool | None = None
) -> DataFrame:
    """As :func:`exec_portfolio`, each premium counted once per policy row and month."""
    return _portfolio(star, calendar, PER_POLICY, distinct)


def _claims_in_calendar(star: Star, calendar: Calendar, grain: str = "month") -> DataFrame:
    incident = F.col("incident_date_key")
    inside = star["fact_claims"].where(
        incident.between(*calendar.key_range()) & F.col("policy_id").isNotNull()
    )
    return inside.withColumn("period", F.trunc(key_date(incident), grain))


def _claims_by_policy(star: Star, calendar: Calendar, grain: str = "month") -> DataFrame:
    """Claims of calendar days, one row per policy and incident period.

    This comes before any join: a policy with very many claims is combined on the map side.
    """
    return _claims_in_calendar(star, calendar, grain).groupBy("policy_id", "period").agg(
        F.count("*").alias("claims"), F.sum("claim_amount_paid").alias("paid")
    )


def _claim_metrics() -> list[Column]:
    count, losses = F.col("claim_count"), F.col("total_losses")
    return [
        ratio(count, F.col("exposed_policies")).alias("claim_frequency"),
        ratio(losses, count).alias("claim_severity"),
        ratio(losses, F.col("total_premium")).alias("loss_ratio"),
    ]


PRODUCT_SEGMENT = ["product_key", *GEOGRAPHY]

#: What claim metrics read of the facts.
CLAIM_COLUMNS = {
    "fact_policies": ["policy_id", *PRODUCT_SEGMENT, "annual_premium"],
    "fact_claims": ["claim_id", "policy_id", "incident_date_key", "claim_amount_paid"],
}


def _claims_by_segment(
    star: Star, calendar: Calendar, repeats: bool, by: list[str] = PRODUCT_SEGMENT, grain: str = "month"
) -> DataFrame:
    """Exposed policies, claims, losses and premium by ``by`` and period.

    A policy is one row of its period, so exposed policies are counted over the whole period. Where ids
    repeat, a policy is one row of each segment it is in before it meets its claims, and different
    claims are counted by :func:`_distinct_claims`.
    """
    policies = star["fact_policies"].select("policy_id", *PRODUCT_SEGMENT, "annual_premium")
    claims = _claims_by_policy(star, calendar, grain)
    if repeats:
        held = _held(star, policies, by)
        sums = claims.join(held, "policy_id").groupBy(*by, "period").agg(
            F.count("*").alias("exposed_policies"),
            F.sum(F.col("paid") * F.col("rows")).alias("total_losses"),
            F.sum(F.col("premium") * F.col("claims")).alias("total_premium"),
        )
        rows = sums.unionByName(_distinct_claims(star, calendar, held, by, grain), allowMissingColumns=True)
        return rows.groupBy(*by, "period").agg(
            F.coalesce(F.sum("exposed_policies"), F.lit(0)).alias("exposed_policies"),
            F.coalesce(F.sum("claim_count"), F.lit(0)).alias("claim_count"),
            F.sum("total_losses").alias("total_losses"),
            F.sum("total_premium").alias("total_premium"),
        )
    joined = claims.join(policies, "policy_id")
    sums = joined.groupBy(*PRODUCT_SEGMENT, "period").agg(
        F.count("*").alias("exposed_policies"),
        F.sum("claims").alias("claim_count"),
        F.sum("paid").alias("total_losses"),
        F.sum(F.col("annual_premium") * F.col("claims")).alias("total_premium"),
    )
    if by == PRODUCT_SEGMENT:
        return sums
    return _with_line(star)(sums).groupBy(*by, "period").agg(
        F.coalesce(F.sum("exposed_policies"), F.lit(0)).alias("exposed_policies"),
        F.coalesce(F.sum("claim_count"), F.lit(0)).alias("claim_count"),
        F.sum("total_losses").alias("total_losses"),
        F.sum("total_premium").alias("total_premium"),
    )


def _held(star: Star, policies: DataFrame, by: list[str]) -> DataFrame:
    """Policy ids and the segments they are in, with the number of rows there and their premium."""
    held = policies.where(F.col("policy_id").isNotNull()).groupBy("policy_id", *PRODUCT_SEGMENT).agg(
        F.count("*").alias("rows"), F.sum("annual_premium").alias("premium")
    )
    if by == PRODUCT_SEGMENT:
        return held
    return _with_line(star)(held).groupBy("policy_id", *by).agg(
        F.sum("rows").alias("rows"), F.sum("premium").alias("premium")
    )


def _distinct_claims(star: Star, calendar: Calendar, held: DataFrame, by: list[str], grain: str) -> DataFrame:
    """Different claims per segment and period, where ids of claims or policies may repeat.

    Segments are numbered and a policy's are bits of words of 64, so a claim of a policy in hundreds of
    segments is a few rows. The words of each claim and period are united on the map side, then claims
    with the same words are counted, and only these counts meet the segments. A policy with very many
    claims meets its words in slices.
    """
    numbered = F.row_number().over(Window.orderBy(*by, F.lit(0))) - 1  # segments only, bounded by the dimensions
    segments = held.select(*by).distinct().withColumn("number", numbered)
    pairs = [F.col(f"h.{name}").eqNullSafe(F.col(f"s.{name}")) for name in by]
    same = reduce(lambda a, b: a & b, pairs, F.lit(True))
    bit = F.expr("shiftleft(1L, number % 64)")
    placed = held.alias("h").join(F.broadcast(segments).alias("s"), same)
    words = placed.groupBy("policy_id", F.expr("number div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    claims = _claims_in_calendar(star, calendar, grain).where(F.col("claim_id").isNotNull())
    claims = claims.select("claim_id", "policy_id", "period")
    found = salted_join(claims, words, "policy_id", spread_by="claim_id", how="inner")
    single = found.groupBy("claim_id", "period", "word").agg(F.bit_or("bits").alias("bits"))
    alike = single.groupBy("period", "word", "bits").agg(F.count("*").alias("claims"))
    numbers = F.expr("transform(filter(sequence(0, 63), i -> shiftright(bits, i) & 1 = 1), i -> word * 64 + i)")
    counts = alike.select("period", "claims", F.explode(numbers).alias("number")).groupBy("number", "period").agg(
        F.sum("claims").alias("claim_count")
    )
    return counts.join(segments, "number").select(*by, "period", "claim_count")


def claims_over(
    star: Star, by: list[str], grain: str, calendar: Calendar | None = None, distinct: bool | None = None
) -> DataFrame:
    """Claim metrics of a month, quarter or year (``grain``) and coarser segments.

    ``by`` is a subset of product, line, state and region. A policy with claims in several months of a
    period is exposed once, so this starts from the facts: exposed policies of months don't add up.
    """
    repeats = _repeats(star, distinct, "fact_policies", "fact_claims")
    rows = _claims_by_segment(star, _calendar(star, calendar), repeats, by, grain)
    amounts = {name: F.col(name).cast(MONEY) for name in ("total_losses", "total_premium")}
    named = rows.withColumns(amounts).withColumnRenamed("period", "period_start")
    counts = ["exposed_policies", "claim_count", "total_losses", "total_premium"]
    return named.select("period_start", *by, *counts, *_claim_metrics())


def _finish_claims(star: Star, rows: DataFrame) -> DataFrame:
    amounts = {name: F.col(name).cast(MONEY) for name in ("total_losses", "total_premium")}
    named = _with_line(star)(rows).withColumns(amounts)
    return named.select(
        *_month_columns(),
        "product_key",
        "line_of_business",
        *GEOGRAPHY,
        "exposed_policies",
        "claim_count",
        "total_losses",
        "total_premium",
        *_claim_metrics(),
    )


def claims_loss(star: Star, calendar: Calendar | None = None, distinct: bool | None = None) -> DataFrame:
    """Claims per incident month, product, state and region.

    Only policies with a claim in the month are exposed, and a policy's premium counts once per
    claim. Claims of unknown policies or of days outside the calendar are left out.
    """
    repeats = _repeats(star, distinct, "fact_policies", "fact_claims")
    calendar = _calendar(star, calendar)
    return _finish_claims(star, _claims_by_segment(star, calendar, repeats))


def claims_loss_true_exposure(
    star: Star, calendar: Calendar | None = None, distinct: bool | None = None
) -> DataFrame:
    """As :func:`claims_loss`, against all policies in force in the month and their premium once.

    Open-ended policies stay in force, as in the daily views. Months without a claim show zeros.
    """
    repeats = _repeats(star, distinct, "fact_policies", "fact_claims")
    calendar = _calendar(star, calendar)
    segment = ["product_key", *GEOGRAPHY]
    exposure = in_force(
        star["fact_policies"],
        calendar,
        segment,
        [InForceSum("total_premium", F.col("annual_premium"), null_if_empty=True)],
        grain="month",
        null_expiration="open",
        distinct=repeats,
    )
    claims = _claims_by_segment(star, calendar, repeats).drop("exposed_policies", "total_premium")
    keys = [*segment, "period"]
    # NULL keys are real segments here, so the match must be null-safe.
    same = [F.col(f"e.{key}").eqNullSafe(F.col(f"c.{key}")) for key in keys]
    # a segment may have a claim in a month in which none of its policies is in force
    joined = exposure.alias("e").join(claims.alias("c"), on=same, how="full")
    exposed = F.col("active_policies").isNotNull()
    rows = joined.select(
        *[F.when(exposed, F.col(f"e.{key}")).otherwise(F.col(f"c.{key}")).alias(key) for key in keys],
        F.coalesce("active_policies", F.lit(0)).alias("exposed_policies"),
        F.coalesce("claim_count", F.lit(0)).alias("claim_count"),
        F.coalesce("total_losses", F.lit(0)).alias("total_losses"),
        "total_premium",
    )
    return _finish_claims(star, rows)


def _operations(
    star: Star, calendar: Calendar | None, distinct: bool | None, exposure: str, factor: Column
) -> DataFrame:
    repeats = _repeats(star, distinct, "fact_policies")
    calendar = _calendar(star, calendar)
    rows = _line_in_force(
        star,
        calendar,
        star["fact_policies"],
        [InForceSum("premium", F.col("monthly_premium"), null_if_empty=True)],
        grain="day",
        null_expiration="open",
        distinct=repeats,
    )
    return rows.select(
        *_day_columns(),
        *LINE_SEGMENT,
        "active_policies",
        factor.alias(exposure),
        F.col("started").alias("policies_started"),
        F.col("ended").alias("policies_ended"),
    )


def operations_daily(star: Star, calendar: Calendar | None = None, distinct: bool | None = None) -> DataFrame:
    """Policies in force, their monthly premium, starts and expirations per day and segment."""
    return _operations(star, calendar, distinct, "daily_premium_exposure", F.col("premium").cast(MONEY))


def operations_daily_equivalent(
    star: Star, calendar: Calendar | None = None, distinct: bool | None = None
) -> DataFrame:
    """As :func:`operations_daily`, the premium as a daily equivalent: monthly x 12 / 365."""
    per_day = (F.col("premium").cast(MONEY) * 12).cast("double") / F.lit(365.0)
    return _operations(star, calendar, distinct, "daily_premium_equivalent", per_day)


#: Name of the joined policies in a star that holds them; a load stores them, so its views don't join.
POLICY_RISKS = "policy_risks"


def policy_risks(star: Star) -> DataFrame:
    """Terms and scores of the policy fact with state, region and renewal flag of the policy dimension."""
    facts = star["fact_policies"].select(
        "policy_id",
        "product_key",
        "effective_date_key",
        "expiration_date_key",
        "policy_year",
        "risk_score",
    )
    return facts.join(star["dim_policies"].select("policy_id", *GEOGRAPHY, "is_renewal"), "policy_id")


def risk_states(
    star: Star,
    calendar: Calendar | None = None,
    high_risk_threshold: float = CONTRACT_RISK_THRESHOLD,
    distinct: bool | None = None,
) -> DataFrame:
    """What :func:`risk_daily` is made of, in a form that adds up: sums and numbers of scores.

    ``score`` and ``scored`` belong to all policies in force, ``new_score`` and ``new_scored`` to new
    business; the other columns are those of the view.

    State and region come from the policy dimension. The two policy tables meet on their key before
    anything is expanded.
    """
    repeats = _repeats(star, distinct, "fact_policies", "dim_policies")
    calendar = _calendar(star, calendar)
    score, renewal = F.col("risk_score"), F.col("is_renewal")
    threshold = F.lit(str(high_risk_threshold)).cast("decimal(10,4)")
    new_score = F.when(~renewal, score)
    sums = [
        InForceSum("score", score),
        InForceSum("scored", score.isNotNull().cast("int")),
        InForceSum("high_risk_policies", F.when(score >= threshold, 1), ids=True),
        InForceSum("new_business_policies", F.when(~renewal, 1), ids=True),
        InForceSum("renewal_policies", F.when(renewal, 1), ids=True),
        InForceSum("new_score", new_score),
        InForceSum("new_scored", new_score.isNotNull().cast("int")),
    ]
    policies = star[POLICY_RISKS] if POLICY_RISKS in star else policy_risks(star)
    rows = _line_in_force(
        star,
        calendar,
        policies,
        sums,
        grain="day",
        null_expiration="open",
        distinct=repeats,
    )
    return rows.select(
        *_day_columns(),
        *LINE_SEGMENT,
        "active_policies",
        "score",
        "scored",
        "high_risk_policies",
        "new_business_policies",
        "renewal_policies",
        "new_score",
        "new_scored",
    )


def risk_daily(
    star: Star,
    calendar: Calendar | None = None,
    high_risk_threshold: float = CONTRACT_RISK_THRESHOLD,
    distinct: bool | None = None,
) -> DataFrame:
    """Risk scores and underwriting mix of the policies in force per day and segment."""
    return risk_of_states(risk_states(star, calendar, high_risk_threshold, distinct))


def risk_of_states(states: DataFrame) -> DataFrame:
    """The risk view of its states."""
    return states.select(
        "day_date",
        "year",
        "month",
        "year_month",
        *LINE_SEGMENT,
        "active_policies",
        ratio(F.col("score"), F.col("scored")).alias("avg_risk_score"),
        "high_risk_policies",
        "new_business_policies",
        "renewal_policies",
        ratio(F.col("new_score"), F.col("new_scored")).alias("avg_new_business_risk"),
    )


def risk_daily_threshold(star: Star, calendar: Calendar | None = None, distinct: bool | None = None) -> DataFrame:
    """:func:`risk_daily` with a threshold inside the 1 to 10 scale of the scores."""
    return risk_daily(star, calendar, SCORE_SCALE_THRESHOLD, distinct)


BUILDERS = {
    "exec_portfolio": exec_portfolio,
    "claims_loss": claims_loss,
    "operations_daily": operations_daily,
    "risk_daily": risk_daily,
}


def build_views(
    star: Star, calendar: Calendar | None = None, distinct: bool | None = None
) -> dict[str, DataFrame]:
    """The four views over one calendar."""
    calendar = _calendar(star, calendar)
    return {name: build(star, calendar, distinct=distinct) for name, build in BUILDERS.items()}


def register_views(star: Star, prefix: str = "vw_dash_") -> list[str]:
    """Make the star tables and the four views visible to SQL; returns the view names."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)
    names = []
    for name, view in build_views(star).items():
        view.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names

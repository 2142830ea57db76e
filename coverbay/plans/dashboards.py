"""Dashboard queries over the semantic views.

The views are already aggregated to segments and periods; these queries roll them up further.
Ratios are always rebuilt from summed numerators and denominators, never averaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.functions.numbers import ratio

LINES = ("Auto", "Health", "Life")
MONEY = "decimal(38,2)"


def slice_view(
    view: DataFrame,
    *,
    line_of_business: str | None = None,
    region_code: str | None = None,
    state_code: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Any combination of dashboard filters. Segment filters move below the view's aggregates."""
    wanted = {
        "line_of_business": line_of_business,
        "region_code": region_code,
        "state_code": state_code,
        "year": year,
    }
    for column, value in wanted.items():
        if value is not None:
            view = view.where(F.col(column) == value)
    return view


def avg_monthly_active(portfolio: DataFrame) -> DataFrame:
    """Mean over a year's months of the policies active in the month."""
    monthly = portfolio.groupBy("year", "year_month").agg(F.sum("active_policies").alias("active"))
    return monthly.groupBy("year").agg(
        ratio(F.sum("active"), F.count("*")).alias("avg_monthly_active_policies")
    )


def _yearly_sum(portfolio: DataFrame, column: str) -> DataFrame:
    return portfolio.groupBy("year").agg(F.sum(column).cast(MONEY).alias(column))


def total_annual_premium(portfolio: DataFrame) -> DataFrame:
    return _yearly_sum(portfolio, "total_annual_premium")


def total_monthly_premium(portfolio: DataFrame) -> DataFrame:
    return _yearly_sum(portfolio, "total_monthly_premium")


def avg_premium_per_policy(portfolio: DataFrame) -> DataFrame:
    return portfolio.groupBy("year").agg(
        ratio(F.sum("total_annual_premium"), F.sum("active_policies")).alias("avg_premium_per_policy")
    )


def yearly_kpis(portfolio: DataFrame) -> DataFrame:
    """The four headline figures of each year, from one pass over the view."""
    monthly = portfolio.groupBy("year", "year_month").agg(
        F.sum("active_policies").alias("active"),
        F.sum("total_annual_premium").cast(MONEY).alias("annual"),
        F.sum("total_monthly_premium").cast(MONEY).alias("monthly"),
    )
    return monthly.groupBy("year").agg(
        ratio(F.sum("active"), F.count("*")).alias("avg_monthly_active_policies"),
        F.sum("annual").cast("double").alias("total_annual_premium"),
        F.sum("monthly").cast("double").alias("total_monthly_premium"),
        ratio(F.sum("annual"), F.sum("active")).alias("avg_premium_per_policy"),
    )


def change_on_prior_year(yearly: DataFrame, metrics: list[str]) -> DataFrame:
    """Each metric with the prior year's value, the difference and the change in percent.

    Every row also stands as prior-year row of the next year, so one aggregate by year pairs
    them: no window over the whole table and no self-join.
    """
    shifted = yearly.select(
        F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"), "year", *metrics
    ).withColumn("year", F.col("year") + F.col("shift"))
    current, prior = F.col("shift") == 0, F.col("shift") == 1
    paired = shifted.groupBy("year").agg(
        F.max(current).alias("is_year"),
        *[F.max(F.when(current, F.col(m))).alias(m) for m in metrics],
        *[F.max(F.when(prior, F.col(m))).alias(f"{m}_prior") for m in metrics],
    )
    columns = []
    for metric in metrics:
        now, before = F.col(metric), F.col(f"{metric}_prior")
        columns += [
            now,
            before,
            (now - before).alias(f"{metric}_change"),
            (ratio(now - before, before) * 100).alias(f"{metric}_change_pct"),
        ]
    return paired.where("is_year").select("year", *columns)


def new_policies_by_month_line(operations: DataFrame) -> DataFrame:
    return operations.groupBy("year_month", "line_of_business").agg(
        F.sum("policies_started").alias("new_policies")
    )


def premium_exposure_by_month_line(portfolio: DataFrame, lines: tuple[str, ...] = LINES) -> DataFrame:
    """Monthly premium per month, one column per line of business and one for all others.

    Premium of a line that isn't listed, or of none, counts in ``other_lines``.
    """
    line, premium = F.col("line_of_business"), F.col("total_monthly_premium")
    listed = F.coalesce(line.isin(*lines), F.lit(False))
    wanted = {name.lower(): line == name for name in lines} | {"other_lines": ~listed}
    return portfolio.groupBy("year_month").agg(
        *[F.sum(F.when(mine, premium)).cast(MONEY).alias(name) for name, mine in wanted.items()]
    )


def premium_by_state_line(portfolio: DataFrame, top: int | None = None) -> DataFrame:
    """Annual premium by year, state and line, states ranked by their total within the year.

    ``top`` keeps the states of the first ranks; ties share a rank.
    """
    by_line = portfolio.groupBy("year", "state_code", "line_of_business").agg(
        F.sum("total_annual_premium").cast(MONEY).alias("annual_premium")
    )
    state = Window.partitionBy("year", "state_code")
    with_total = by_line.withColumn(
        "state_premium", F.sum("annual_premium").over(state).cast(MONEY)
    )
    ranking = Window.partitionBy("year").orderBy(F.desc("state_premium"))
    ranked = with_total.withColumn("state_rank", F.dense_rank().over(ranking))
    return ranked if top is None else ranked.where(F.col("state_rank") <= top)


def claims_rollup(claims: DataFrame, by: list[str]) -> DataFrame:
    """Claim metrics of coarser segments within a month.

    ``by`` is a subset of product, line, state and region; a policy belongs to one of each, so
    exposed policies add up. They do not add up across months: ``views.claims_over`` counts those.
    """
    sums = claims.groupBy("year_month", *by).agg(
        F.sum("exposed_policies").alias("exposed_policies"),
        F.sum("claim_count").alias("claim_count"),
        F.sum("total_losses").cast(MONEY).alias("total_losses"),
        F.sum("total_premium").cast(MONEY).alias("total_premium"),
    )
    count, losses = F.col("claim_count"), F.col("total_losses")
    return sums.withColumns(
        {
            "claim_frequency": ratio(count, F.col("exposed_policies")),
            "claim_severity": ratio(losses, count),
            "loss_ratio": ratio(losses, F.col("total_premium")),
        }
    )


def operations_by_day(operations: DataFrame) -> DataFrame:
    return operations.groupBy("day_date").agg(
        F.sum("active_policies").alias("active_policies"),
        F.sum("policies_started").alias("policies_started"),
        F.sum("policies_ended").alias("policies_ended"),
    )


def _share(part: Column, whole: Column) -> Column:
    return ratio(F.sum(part), F.sum(whole))


def risk_by_day(risk: DataFrame) -> DataFrame:
    """Daily mean score, high-risk count and underwriting mix.

    ``risk`` are the view's states, whose sums and numbers of scores add up over segments, or the view
    itself, whose means are then weighted by active policies: that is the mean of all scored policies
    only where each segment's policies all have a score or none has.
    """
    active = F.col("active_policies")
    if "scored" in risk.columns:
        score, scored = F.col("score"), F.col("scored")
    else:
        scored = F.when(F.col("avg_risk_score").isNotNull(), active)
        # as decimals the weighted scores add up to the same total in any order
        score = (F.col("avg_risk_score") * scored).cast("decimal(28,6)")
    return risk.groupBy("day_date").agg(
        F.sum("active_policies").alias("active_policies"),
        _share(score, scored).alias("avg_risk_score"),
        F.sum("high_risk_policies").alias("high_risk_policies"),
        _share(F.col("new_business_policies"), active).alias("new_business_share"),
        _share(F.col("renewal_policies"), active).alias("renewal_share"),
    )

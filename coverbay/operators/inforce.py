"""Policies in force per period, without one row per policy per day.

A policy in force from ``start`` to ``end`` touches two periods in a special way: the one it
starts in and the one it ends in. It is therefore written as two events. Summing the events per
segment and period and then running those sums forward gives, for every period,

* per-policy sums: each policy in force at any time of the period counted once, and
* per-day sums: each policy counted once for every day of the period it is in force.

With ``running`` the sum over policies started and not yet ended when the period closes,

    per policy = running + sum over policies ending in the period
    per day    = running * days in the period
                 - sum(value * days before the start)   over policies starting in the period
                 + sum(value * days up to the end)      over policies ending in the period

Where a policy id may repeat, counts of ids are summed from other events (``distinct``): a policy's terms
within a segment are first reduced to the latest end per start, on the map side, and then cut so that
none covers a period that an earlier one covers, by a running maximum of the ends. An id is thus counted
once per period however many of its rows overlap, and has a row per period at most in that window. Sums
still count every row.

The cost is two rows per policy before a map-side aggregate, and segments x periods after it.
Periods are days or calendar months; a window partition holds one segment's periods, so its size
is bounded by the calendar, however many policies the segment has.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.functions.dates import date_key, key_date, month_start

#: Rows in force, where ids are counted apart from them.
_ROWS = "rows_in_force__"
#: The end of a term that goes on after the calendar.
_OPEN = datetime.date(9999, 12, 31)
_STARTED, _ENDED = -1, -2

PER_POLICY = "policy"
PER_DAY = "day"


@dataclass(frozen=True)
class InForceSum:
    """A sum over policies in force. ``value`` is a column of the policies, NULL adds nothing.

    With ``null_if_empty`` the sum is NULL, not zero, when no policy in force has a value. With ``ids``
    it is the number of different policies with a value, not of rows, where ids may repeat.
    """

    name: str
    value: Column
    per: str = PER_POLICY
    null_if_empty: bool = False
    ids: bool = False


class BadCalendar(Exception):
    """A calendar that is not one row per day, or whose columns disagree with its dates."""


def calendar_columns(day: Column) -> list[Column]:
    """Year, month and ``yyyy-MM`` text of a day, as the calendar table holds them."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    ]


@dataclass(frozen=True)
class Calendar:
    """First and last day of a calendar table that has one row for every day between them.

    The days are fetched by one aggregate over the calendar table. Views then compare keys with
    literals, so such filters reach the Parquet scan of the facts, and derive calendar columns
    from the day instead of joining them: the aggregate has checked that both give the same.
    """

    first_day: datetime.date
    last_day: datetime.date

    @classmethod
    def of(cls, dim_time: DataFrame) -> Calendar:
        derived = calendar_columns(F.col("full_date"))
        names = ["year", "month", "year_month"]
        agrees = [F.col(name).eqNullSafe(value) for name, value in zip(names, derived)]
        agrees.append(F.col("date_key").eqNullSafe(date_key(F.col("full_date"))))
        first, last, rows, wrong = dim_time.agg(
            F.min("full_date"),
            F.max("full_date"),
            F.count("*"),
            F.count_if(~reduce(lambda a, b: a & b, agrees)),
        ).first()
        if rows == 0 or rows != (last - first).days + 1 or wrong:
            raise BadCalendar(f"{rows} rows from {first} to {last}, {wrong} disagree with their date")
        return cls(first, last)

    def of_year(self, year: int) -> Calendar:
        """The part of the calendar in one year.

        A view over it equals the view over the whole calendar filtered to the year, but policies
        and claims outside the year are already left out when the facts are read. A year outside
        the calendar has no days, and its views no rows.
        """
        return Calendar(
            max(self.first_day, datetime.date(year, 1, 1)),
            min(self.last_day, datetime.date(year, 12, 31)),
        )

    def is_empty(self) -> bool:
        return self.first_day > self.last_day

    def key_range(self) -> tuple[int, int]:
        """First and last day as ``yyyymmdd`` keys."""
        return int(f"{self.first_day:%Y%m%d}"), int(f"{self.last_day:%Y%m%d}")


def terms_in_calendar(policies: DataFrame, calendar: Calendar, null_expiration: str) -> DataFrame:
    """Policies in force on some calendar day, with their term cut to the calendar.

    ``null_expiration`` is ``"open"`` (in force to the end of the calendar) or ``"single_day"``.
    Adds ``term_start``, ``term_end``, and whether the policy starts and ends in the calendar.
    """
    first, last = F.lit(calendar.first_day), F.lit(calendar.last_day)
    effective, expiration = F.col("effective_date_key"), F.col("expiration_date_key")
    if null_expiration == "single_day":
        expiration = F.coalesce(expiration, effective)

    # Keys compare like dates; only keys inside the calendar are turned into dates.
    first_key, last_key = calendar.key_range()
    in_calendar = (effective <= last_key) & F.coalesce(
        (expiration >= first_key) & (expiration >= effective), F.lit(True)
    )
    if calendar.is_empty():
        in_calendar = F.lit(False)
    if "policy_year" in policies.columns:
        # the partition column of the stored table: later years are not read at all
        in_calendar &= F.coalesce(F.col("policy_year") <= calendar.last_day.year, F.lit(True))
    starts = effective >= first_key
    ends = F.coalesce(expiration <= last_key, F.lit(False))
    return policies.where(in_calendar).withColumns(
        {
            "starts": starts,
            "ends": ends,
            "term_start": F.when(starts, key_date(effective)).otherwise(first),
            "term_end": F.when(ends, key_date(expiration)).otherwise(last),
        }
    )


def in_force(
    policies: DataFrame,
    calendar: Calendar,
    segment: list[str],
    sums: list[InForceSum],
    *,
    grain: str,
    null_expiration: str,
    regroup: Callable[[DataFrame], DataFrame] | None = None,
    keep: list[str] | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Sums over the policies in force per segment and period, periods without a policy left out.

    ``grain`` is ``"month"`` or ``"day"``. ``regroup`` is applied to the pre-aggregated events, a
    DataFrame with the columns of ``segment`` among others, and may replace segment columns by
    those in ``keep``: a dimension is joined to the few aggregated rows, never to the policies.

    Returns the segment columns, ``period`` (first day of the month, or the day),
    ``active_policies``, ``started``, ``ended`` and one column per sum. With ``distinct`` these
    count different values of ``policy_id``, NULL none; without it they count rows, which is the
    same where ids are unique.
    """
    wanted = [InForceSum("active_policies", F.lit(1), ids=True), *sums]
    counted = [one for one in wanted if one.ids] if distinct else []
    if distinct:
        wanted = [InForceSum(_ROWS, F.lit(1)), *[one for one in wanted if not one.ids]]
    wanted += [
        InForceSum(_present(one.name), one.value.isNotNull().cast("int"))
        for one in sums
        if one.null_if_empty
    ]
    terms = terms_in_calendar(policies, calendar, null_expiration).select(
        *(["policy_id"] if distinct else []),
        *segment,
        "term_start",
        "term_end",
        "starts",
        "ends",
        *[one.value.alias(f"v_{one.name}") for one in [*wanted, *counted]],
    )
    by_period = _sum_events(terms, calendar, segment, wanted, grain)
    if regroup is not None:
        totals = [name for name in by_period.columns if name not in (*segment, "period")]
        segment = keep
        by_period = regroup(by_period).groupBy(*segment, "period").agg(
            *[F.sum(name).alias(name) for name in totals]
        )
    if distinct:
        named = terms if regroup is None else regroup(terms)
        counts = _count_events(named, calendar, segment, counted, grain)
        both = by_period.drop("started", "ended").unionByName(counts, allowMissingColumns=True)
        totals = [name for name in both.columns if name not in (*segment, "period")]
        by_period = both.groupBy(*segment, "period").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in totals])
        wanted += counted
    present = _ROWS if distinct else "active_policies"
    filled = _run_forward(by_period, calendar, segment, wanted, grain, present)

    total = {one.name: _total(one, calendar, grain) for one in wanted}
    columns = [total["active_policies"].alias("active_policies")]
    for one in sums:
        value = total[one.name]
        if one.null_if_empty:
            value = F.when(total[_present(one.name)] > 0, value)
        columns.append(value.alias(one.name))
    return filled.select(
        *segment,
        "period",
        F.when(_is_event(), F.col("started")).otherwise(0).alias("started"),
        F.when(_is_event(), F.col("ended")).otherwise(0).alias("ended"),
        *columns,
        *([total[_ROWS].alias(_ROWS)] if distinct else []),
    ).where(F.col(present) > 0).drop(_ROWS)


def ids_are_unique(table: DataFrame, column: str) -> bool:
    """No value occurs twice and none is NULL; one aggregate over the column."""
    counts = table.groupBy(column).agg(F.count("*").alias("n"))
    return counts.where((F.col("n") > 1) | F.col(column).isNull()).isEmpty()


def _is_event() -> Column:
    """The period is the one whose events the row carries, not a later one it stands for."""
    return F.col("period") == F.col("event_period")


def _present(name: str) -> str:
    """Name of the helper sum that counts the values present in another sum."""
    return f"{name}__n"


def _sum_events(
    terms: DataFrame, calendar: Calendar, segment: list[str], wanted: list[InForceSum], grain: str
) -> DataFrame:
    """Two events per policy, summed per segment and the period they fall in."""
    events = F.array(
        F.struct(F.col("term_start").alias("day"), F.lit(False).alias("is_end")),
        F.struct(F.when(F.col("ends"), F.col("term_end")).alias("day"), F.lit(True).alias("is_end")),
    )
    day, is_end = F.col("event.day"), F.col("event.is_end")
    period = month_start(day) if grain == "month" else day
    # Days of the period before a start, or up to and including an end.
    offset = F.datediff(day, F.greatest(period, F.lit(calendar.first_day))) + is_end.cast("int")
    totals = [
        F.count(F.when(~is_end & F.col("starts"), 1)).alias("started"),
        F.count(F.when(is_end, 1)).alias("ended"),
    ]
    for one in wanted:
        value = F.col(f"v_{one.name}")
        signed = F.when(is_end, -value).otherwise(value)
        if one.per == PER_DAY:
            extra = -signed * offset.cast("decimal(5,0)")
        else:
            extra = F.when(is_end, value)
        totals.append(F.sum(signed).alias(f"change_{one.name}"))
        totals.append(F.sum(extra).alias(f"extra_{one.name}"))
    exploded = terms.withColumn("event", F.explode(events)).where(day.isNotNull())
    return exploded.withColumn("period", period).groupBy(*segment, "period").agg(*totals)


def _count_events(
    terms: DataFrame, calendar: Calendar, segment: list[str], counted: list[InForceSum], grain: str
) -> DataFrame:
    """Starts and ends of the periods in which an id counts, summed per segment and period."""

    def period(day: Column) -> Column:
        return month_start(day) if grain == "month" else day

    def kind(number: int, when: Column, start: Column, end: Column) -> Column:
        return F.when(when, F.struct(F.lit(number).alias("kind"), start.alias("start"), end.alias("end")))

    start, end = period(F.col("term_start")), period(F.col("term_end"))
    until = F.when(F.col("ends"), end).otherwise(F.lit(_OPEN))
    kinds = [kind(i, F.col(f"v_{one.name}").isNotNull(), start, until) for i, one in enumerate(counted)]
    kinds += [kind(_STARTED, F.col("starts"), start, start), kind(_ENDED, F.col("ends"), end, end)]
    rows = terms.where(F.col("policy_id").isNotNull()).select("policy_id", *segment, F.explode(F.array_compact(F.array(*kinds))).alias("k"))
    key = ["policy_id", *segment, "kind"]
    longest = rows.select("policy_id", *segment, "k.*").groupBy(*key, "start").agg(F.max("end").alias("end"))
    earlier = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.col("covered")
    after = F.add_months(covered, 1) if grain == "month" else F.date_add(covered, 1)
    cut = longest.withColumn("covered", F.max("end").over(earlier)).where(covered.isNull() | (F.col("end") > covered))
    cut = cut.withColumn("start", F.when(covered.isNull() | (F.col("start") > covered), F.col("start")).otherwise(after))
    cut = cut.where(F.col("start") <= F.lit(calendar.last_day))  # what only goes on after the calendar
    events = F.array(
        F.struct(F.col("start").alias("period"), F.lit(False).alias("is_end")),
        F.struct(F.when((F.col("end") < F.lit(_OPEN)) & (F.col("kind") >= 0), F.col("end")).alias("period"), F.lit(True).alias("is_end")),
    )
    is_end = F.col("event.is_end")
    totals = [F.count(F.when(F.col("kind") == number, 1)).alias(name) for number, name in ((_STARTED, "started"), (_ENDED, "ended"))]
    for i, one in enumerate(counted):
        mine = F.col("kind") == i
        totals.append(F.sum(F.when(mine & is_end, -1).when(mine, 1)).alias(f"change_{one.name}"))
        totals.append(F.sum(F.when(mine & is_end, 1)).alias(f"extra_{one.name}"))
    exploded = cut.withColumn("event", F.explode(events)).where(F.col("event.period").isNotNull())
    return exploded.groupBy(*segment, F.col("event.period").alias("period")).agg(*totals)


def _run_forward(
    by_period: DataFrame, calendar: Calendar, segment: list[str], wanted: list[InForceSum], grain: str, present: str
) -> DataFrame:
    """Running sums; each row then stands for all periods up to the segment's next events."""
    ordered = Window.partitionBy(*segment).orderBy("period")
    to_here = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = by_period.select(
        *segment,
        F.col("period").alias("event_period"),
        F.lead("period").over(ordered).alias("next_period"),
        "started",
        "ended",
        *[F.sum(f"change_{one.name}").over(to_here).alias(f"running_{one.name}") for one in wanted],
        *[f"extra_{one.name}" for one in wanted],
    )
    last = F.lit(calendar.last_day)
    if grain == "month":
        step, last, before_next = "1 month", month_start(last), F.add_months("next_period", -1)
    else:
        step, before_next = "1 day", F.date_sub("next_period", 1)
    # With nothing in force any more, the row stands for its own period only.
    until = F.when(F.col(f"running_{present}") > 0, F.coalesce(before_next, last))
    until = until.otherwise(F.col("event_period"))
    periods = F.sequence("event_period", until, F.expr(f"interval {step}"))
    return running.withColumn("period", F.explode(periods))


def _total(one: InForceSum, calendar: Calendar, grain: str) -> Column:
    """The sum of one period, from the running sum and the period's own events."""
    running = F.col(f"running_{one.name}")
    if one.per == PER_DAY and grain == "month":
        first, last = F.lit(calendar.first_day), F.lit(calendar.last_day)
        days = F.datediff(F.least(F.last_day("period"), last), F.greatest("period", first)) + 1
        running = running * days.cast("decimal(5,0)")
    extra = F.when(_is_event(), F.col(f"extra_{one.name}"))
    return F.coalesce(running, F.lit(0)) + F.coalesce(extra, F.lit(0))

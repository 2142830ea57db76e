"""Calendar expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType


def strict_date(df: DataFrame, name: str) -> Column:
    """ISO text or date column as a date; text that is not a date raises."""
    if isinstance(df.schema[name].dataType, DateType):
        return F.col(name)
    return F.to_date(F.col(name), "yyyy-MM-dd")


def lenient_date(df: DataFrame, name: str) -> Column:
    """As :func:`strict_date`, but text that is not a date becomes NULL."""
    if isinstance(df.schema[name].dataType, DateType):
        return F.col(name)
    return F.col(name).try_cast("date")


def date_key(date: Column) -> Column:
    """Integer ``yyyymmdd``, by arithmetic rather than by formatting text."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def month_key(date: Column) -> Column:
    """Integer key of the first day of the date's month."""
    return (F.year(date) * 10000 + F.month(date) * 100 + 1).cast("int")


def key_date(key: Column) -> Column:
    """Date of an integer ``yyyymmdd`` key; a key that is no calendar day raises."""
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def iso_weekday(date: Column) -> Column:
    """Monday = 1 to Sunday = 7 (``dayofweek`` starts at Sunday)."""
    return F.weekday(date) + 1


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def month_text_date(year_month: Column) -> Column:
    """First day of a ``yyyy-MM`` text."""
    return F.to_date(F.concat(year_month, F.lit("-01")), "yyyy-MM-dd")


def days_inclusive(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverbay.functions import dates, numbers, text

D = datetime.date


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    ("day", "key", "month_key", "weekday", "weekend"),
    [
        (D(2024, 2, 29), 20240229, 20240201, 4, False),
        (D(2024, 3, 2), 20240302, 20240301, 6, True),
        (D(2024, 3, 3), 20240303, 20240301, 7, True),
        (D(2024, 12, 30), 20241230, 20241201, 1, False),
        (D(1000, 1, 1), 10000101, 10000101, 3, False),
    ],
)
def test_calendar_expressions(spark, day, key, month_key, weekday, weekend):
    d = F.lit(day)
    assert one(
        spark, dates.date_key(d), dates.month_key(d), dates.iso_weekday(d), dates.is_weekend(d)
    ) == (key, month_key, weekday, weekend)
    assert one(spark, dates.key_date(F.lit(key))) == (day,)


def test_key_of_null_and_of_no_day(spark):
    assert one(spark, dates.date_key(F.lit(None).cast("date")), dates.key_date(F.lit(None).cast("int"))) == (
        None,
        None,
    )
    with pytest.raises(Exception, match="20240230|February|DATETIME"):
        one(spark, dates.key_date(F.lit(20240230)))


def test_strict_and_lenient_dates(spark):
    df = spark.createDataFrame([("2024-01-31",), ("soon",), (None,)], "d string")
    assert [r[0] for r in df.select(dates.lenient_date(df, "d")).collect()] == [D(2024, 1, 31), None, None]
    with pytest.raises(Exception, match="soon|PARSE"):
        df.select(dates.strict_date(df, "d")).collect()


def test_month_text_and_days(spark):
    assert one(
        spark,
        dates.month_text_date(F.lit("2024-02")),
        dates.month_start(F.lit(D(2024, 2, 29))),
        dates.days_inclusive(F.lit(D(2024, 2, 28)), F.lit(D(2024, 3, 1))),
    ) == (D(2024, 2, 1), D(2024, 2, 1), 3)


def test_ratio_needs_a_positive_denominator(spark):
    def r(a, b):
        return numbers.ratio(F.lit(a).cast("decimal(18,2)"), F.lit(b).cast("decimal(18,2)"))

    assert one(spark, r("1", "4"), r("1", "0"), r("1", "-4"), r(None, "4"), r("1", None)) == (
        0.25,
        None,
        None,
        None,
        None,
    )


def test_rounding_is_half_even_and_clip_keeps_null(spark):
    def m(value):
        return numbers.money_round(F.lit(value).cast("decimal(18,4)"))

    assert one(spark, m("0.125"), m("0.135"), m("0.1251"), m("-0.125")) == tuple(
        map(Decimal, ("0.12", "0.14", "0.13", "-0.12"))
    )
    assert one(
        spark,
        numbers.clip(F.lit(12), 1, 10),
        numbers.clip(F.lit(-1), 1, 10),
        numbers.clip(F.lit(None).cast("int"), 1, 10),
    ) == (10, 1, None)


def test_product_key(spark):
    def k(line, plan):
        return text.product_key(F.lit(line).cast("string"), F.lit(plan).cast("string"))

    assert one(spark, k("Auto", "Full cover"), k("Auto", None), k(None, "Full")) == (
        "AUTO_FULL_COVER",
        None,
        None,
    )


def test_ids_are_padded_and_never_cut(spark):
    assert one(
        spark,
        text.padded_id("C", F.lit(42), 7),
        text.padded_id("C", F.lit(123456789), 7),
        text.padded_id("CL", F.lit(1), 9),
    ) == ("C0000042", "C123456789", "CL000000001")


def test_tolerant_flag(spark):
    texts = ["1", "TRUE", "t", "Yes", "no", "", "abc", None]
    df = spark.createDataFrame([(t,) for t in texts], "f string")
    flags = [r[0] for r in df.select(text.tolerant_flag(F.col("f"))).collect()]
    assert flags == [True, True, True, True, False, False, False, False]
    assert one(spark, text.tolerant_flag(F.lit(True)), text.tolerant_flag(F.lit(False))) == (True, False)

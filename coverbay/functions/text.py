"""Text expressions: product keys, business ids and tolerant flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts read as true in a claim's fraud flag, in lower case.
TRUE_TEXTS = ("1", "true", "t", "yes")


def product_key(line_of_business: Column, plan_name: Column) -> Column:
    """``LOB_PLAN`` in upper case with spaces as underscores; NULL if either part is."""
    joined = F.concat(line_of_business, F.lit("_"), plan_name)
    return F.upper(F.translate(joined, " ", "_"))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """Prefix and a zero-padded number; a number wider than ``width`` keeps all its digits."""
    digits = number.cast("string")
    # lpad alone would cut longer numbers and make ids collide
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0"))


def tolerant_flag(flag: Column) -> Column:
    """TRUE for the accepted texts in any case, FALSE for everything else and for NULL.

    A cast to boolean would raise on other text under ANSI mode.
    """
    return F.coalesce(F.lower(flag.cast("string")).isin(*TRUE_TEXTS), F.lit(False))

"""Keys, money and exact ratios.

Money is summed as ``decimal(15,2)``: sums of doubles depend on the order in
which tasks finish. Averages and ratios divide decimals whose widths leave 15 or
more fractional digits, so the final rounding is the only one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bankmart.schemas import MONEY


# Digits that fit a long, with or without zeros after the point; and all that a number can look like.
PLAIN_KEY = r"\A[+-]?[0-9]{1,18}(?:\.0*)?\z"
NUMBER = r"\A[\x00-\x20\x7F]*[+-]?(?:\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)(?:[eE][+-]?\p{Nd}+)?[\x00-\x20\x7F]*\z"


def key(value: Column) -> Column:
    """Text to a long key. ``'7.0'`` reads as 7; what is not a whole number is null.

    A cast that fails raises and catches an exception with its message, which costs far more
    than reading a row; so a text is cast only to what its form shows that it can be.
    """
    number = value.try_cast("decimal(38,18)")
    other = F.coalesce(value.try_cast("bigint"), F.when(number % 1 == 0, number.try_cast("bigint")))
    plain = F.substring_index(value, ".", 1).try_cast("bigint")
    return F.when(value.rlike(PLAIN_KEY), plain).when(value.rlike(NUMBER), other)


def amount(value: Column) -> Column:
    return value.try_cast("double")


def money(value: Column) -> Column:
    return value.cast(MONEY)


def nonzero(value: Column) -> Column:
    """Null instead of zero, for divisors."""
    return F.nullif(value, F.lit(0))


def exact_average(total: Column, count: Column, places: int = 2) -> Column:
    """``total / count`` of money, rounded half away from zero; null for no rows."""
    quotient = total.cast("decimal(25,2)") / nonzero(count).cast("decimal(18,0)")
    return F.round(quotient, places).cast("decimal(25,2)")


def exact_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` of two counts as ``decimal(38,18)``; null when whole is 0."""
    return part.cast("decimal(20,0)") / nonzero(whole).cast("decimal(17,0)")


def percent(part: Column, whole: Column, places: int) -> Column:
    """``100 * part / whole`` of two counts, rounded half away from zero."""
    hundredfold = part.cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(exact_ratio(hundredfold, whole), places).cast(f"decimal(12,{places})")

"""Casts that give null instead of failing, exact money sums, ratios and margins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts are summed as decimals of six places, and rounded where they are shown.
MONEY = "decimal(28,6)"


def safe_int(value: Column) -> Column:
    """Text to integer, null when it is not a whole number."""
    return value.try_cast("bigint")


def safe_round_int(value: Column) -> Column:
    """Floating number to the nearest integer."""
    return F.round(value).try_cast("bigint")


def safe_double(value: Column) -> Column:
    return value.try_cast("double")


def digits_only_int(value: Column) -> Column:
    """Text made of digits to integer; blank or anything else is null."""
    text = F.trim(value)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.round(ratio(numerator, denominator) * 100, 2)


def money_sum(value: Column) -> Column:
    """Sum amounts as decimals, so the order of addition cannot change the result.

    Fractions of a cent count; nothing is rounded to cents before the sum.
    """
    return F.sum(value.cast(MONEY)).cast("double")


def margin(list_price: Column, cost: Column) -> Column:
    """(list - cost) / list, zero where the list price is not positive."""
    return F.when(list_price > 0, ratio(list_price - cost, list_price)).otherwise(F.lit(0.0))

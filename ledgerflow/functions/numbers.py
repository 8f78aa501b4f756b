"""Ratios, rounding, calendar parts and elapsed time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0.0 where the denominator is 0."""
    return F.coalesce(blank_divide(numerator, denominator), F.lit(0.0))


def blank_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient rounded half up on its decimal value, as double.

    Dividing decimals keeps ties such as 1.005 exact; a double quotient would not."""
    exact = F.try_divide(numerator.cast("decimal(28,2)"), denominator.cast("decimal(18,0)"))
    return F.round(exact, places).cast("double")


def whole_units(amount: Column) -> Column:
    """Nearest whole number, ties to even."""
    return F.bround(amount, 0)


def cents(amount: Column) -> Column:
    """Whole cents; amounts beyond the range of a long are held at its ends."""
    ends = F.lit((1 << 63) - 1), F.lit(1 - (1 << 63))
    whole = F.round(amount, 2).cast("decimal(36,2)") * 100
    return F.coalesce(whole.try_cast("bigint"), F.when(amount > 0, ends[0]).when(amount < 0, ends[1]))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def elapsed(earlier: Column, later: Column, unit_seconds: int) -> Column:
    """Time between two timestamps in fractional units (60 = minutes, 3600 = hours)."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(unit_seconds * 1_000_000)

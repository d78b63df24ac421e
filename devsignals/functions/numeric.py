"""Exact decimal rounding of integer ratios.

Rounding a double is off by one unit on ties (1.005 is stored below 1.005), so a
ratio is rounded half away from zero in whole numbers and only then scaled.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded_ratio(numerator: Column, denominator: Column, decimals: int, scale: int = 1) -> Column:
    """`numerator * scale / denominator` at `decimals` places; NULL when the denominator is 0."""
    shift = 10 ** decimals
    bottom = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    top = F.abs(numerator.cast("bigint"))
    units = F.call_function("div", top * F.lit(2 * shift * scale) + bottom, bottom * F.lit(2))
    signed = F.when(numerator < 0, -units).otherwise(units)
    return signed.cast("double") / F.lit(float(shift))


def ratio(numerator: Column, denominator: Column, decimals: int = 2) -> Column:
    return rounded_ratio(numerator, denominator, decimals)


def percent(numerator: Column, denominator: Column, decimals: int = 2) -> Column:
    return rounded_ratio(numerator, denominator, decimals, scale=100)


def mean(column: Column, decimals: int = 2) -> Column:
    """Aggregate: rounded mean of a whole-number column, NULLs skipped, NULL when empty."""
    return rounded_ratio(F.sum(column), F.count(column), decimals)


def hundredths(column: Column) -> Column:
    """A value with two decimals as a whole number of hundredths."""
    return F.round(column * F.lit(100.0)).cast("bigint")


def mean_of_percents(column: Column) -> Column:
    """Aggregate: unweighted mean of two-decimal percentages, NULLs skipped."""
    whole = hundredths(column)
    return rounded_ratio(F.sum(whole), F.count(whole), 0) / F.lit(100.0)

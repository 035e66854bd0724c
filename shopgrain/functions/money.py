"""Exact money arithmetic in whole-number units.

Amounts arrive as doubles. A double sum depends on the order in which tasks
deliver their rows, so sums run over decimal units of 1/10000 of a currency unit.
A row keeps ten decimals of its amount and may reach 10^18; totals are decimals of
38 digits, so that even the grand total of a very large table cannot overflow.
Nothing is rounded before the output column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000  # per currency unit
UNITS_PER_CENT = UNITS // 100


def to_units(amount: Column) -> Column:
    """Units of one row, with fractions; a row beyond 10^18 currency units fails the query."""
    return amount.cast("decimal(28,10)") * F.lit(UNITS).cast("decimal(5,0)")


def total_units(amount: Column) -> Column:
    """Aggregate: the exact sum of amounts, as a decimal number of units."""
    return F.sum(to_units(amount))


def units_to_cents(units: Column) -> Column:
    """Decimal units to decimal cents, rounded half away from zero."""
    return F.round(units / F.lit(UNITS_PER_CENT).cast("decimal(3,0)"), 0)


def from_units(units: Column) -> Column:
    return units.cast("double") / F.lit(float(UNITS))


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def rounded(units: Column) -> Column:
    """Units as a double rounded to cents."""
    return from_cents(units_to_cents(units))


def divide_half_up(numerator: Column, denominator: Column | int) -> Column:
    """Integer division rounded half away from zero, for whole numbers of any
    width. The denominator is positive and the quotient fits 64 bits."""
    denominator = F.lit(denominator).cast("bigint") if isinstance(denominator, int) else denominator
    quotient = F.call_function("div", F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.signum(numerator).cast("bigint") * quotient


def share(part: Column, whole: Column) -> Column:
    """Percentage; NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)

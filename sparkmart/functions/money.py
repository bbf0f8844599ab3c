"""Exact two-decimal averages and ratios.

A quotient rounded to some digits and then to two can be a cent off, and doubles more so. Both
sides are therefore made whole numbers first, and the division rounds once, half away from zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

LOW_BITS = 20


def whole_quotient(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator to the nearest whole number; NULL where the denominator is 0."""
    top = numerator.cast("decimal(38,0)")
    bottom = F.nullif(denominator.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    doubled = F.abs(top) * 2 + F.abs(bottom)
    size = F.call_function("div", doubled, F.abs(bottom) * 2)
    return size * F.signum(top).cast("int") * F.signum(bottom).cast("int")


def hundredths(value: Column) -> Column:
    """A whole number of hundredths as a two-decimal value."""
    return (value.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def average(total: Column, count: Column) -> Column:
    """total / count in two decimals, for a two-decimal or whole total."""
    return hundredths(whole_quotient(total * 100, count))


def percent(part: Column, base: Column) -> Column:
    """part as a percentage of base in two decimals; NULL where base is 0."""
    return hundredths(whole_quotient(part * 1000000, base * 100))


def sum_money(column: str) -> Column:
    """Exact sum of a two-decimal column of single rows.

    Spark sums decimals of this size as objects, outside its fast hash map. Hundredths are
    whole numbers, summed in two parts of which neither can outgrow a bigint below eight
    trillion rows; the parts are put together exactly.
    """
    cents = (F.col(column) * 100).cast("bigint")
    high = F.sum(F.shiftright(cents, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(cents.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    return ((high * (1 << LOW_BITS) + low) * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def total(column: str) -> Column:
    """Exact sum of amounts that are sums themselves; there are few of them."""
    return F.sum(column).cast("decimal(28,2)")

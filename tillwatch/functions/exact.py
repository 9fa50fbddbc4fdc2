"""Half-up rounding of quotients on integers, so no result depends on binary fractions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def quotient(num: Column, den: Column, places: int, precision: int = 18) -> Column:
    """``num / den`` rounded half-up to ``places``, as a decimal; null when ``den`` is 0 or null.

    ``num`` and ``den`` are non-negative integers (bigint or decimal(p,0)).
    """
    unit = 10**places
    den = F.nullif(den, F.lit(0))
    halves = num * F.lit(2 * unit) + den
    steps = F.call_function("div", halves, den * F.lit(2))
    return (steps * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal({precision},{places})")


def percent(part: Column, whole: Column, places: int) -> Column:
    """``100 * part / whole`` rounded half-up to ``places``, as a decimal."""
    return quotient(part * F.lit(100), whole, places, precision=places + 5)


def mean(total: Column, n: Column) -> Column:
    """Unrounded mean of an exact decimal total, as double."""
    return total.cast("double") / F.nullif(n, F.lit(0))


def hundredths(amount: Column) -> Column:
    """A decimal(p,2) amount as a whole number of hundredths."""
    return (amount * F.lit(100)).cast("decimal(34,0)")


def count_where(condition: Column) -> Column:
    """``count(*) filter (where condition)``."""
    return F.count(F.when(condition, F.lit(1)))


def sum_where(value: Column, condition: Column) -> Column:
    """``sum(value) filter (where condition)``: null when no row qualifies."""
    return F.sum(F.when(condition, value))

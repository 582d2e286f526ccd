"""Exact rounding on integers.

Money and percentages land on .5 ties all the time, where floating rounding differs from engine to
engine and sums depend on the order of the rows. Amounts carry at most two decimals, so they are
summed as whole cents and every rounded ratio is one integer division, rounded half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)


def ratio_half_up(num: Column, den: Column, places: int) -> Column:
    """``num / den`` of two non-negative whole numbers at ``places`` decimals; null where den is 0."""
    scale = 10**places
    den = F.nullif(den.cast("bigint"), F.lit(0).cast("bigint"))
    return whole_div(num.cast("bigint") * F.lit(2 * scale) + den, den * F.lit(2)) / F.lit(float(scale))


def percent_half_up(num: Column, den: Column, places: int = 1) -> Column:
    return ratio_half_up(num.cast("bigint") * F.lit(100), den, places)


def to_cents(amount: Column) -> Column:
    return F.round(amount * F.lit(100.0)).cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents / F.lit(100.0)


def mean_cents_as_money(sum_cents: Column, rows: Column) -> Column:
    """Average amount at two decimals from a sum of cents (half up)."""
    rows = F.nullif(rows.cast("bigint"), F.lit(0).cast("bigint"))
    return from_cents(whole_div(sum_cents * F.lit(2) + rows, rows * F.lit(2)))


def count_where(condition: Column) -> Column:
    """Rows on which the condition is true (null counts as not true); 0 on empty input."""
    return F.count(F.when(condition, F.lit(1)))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))

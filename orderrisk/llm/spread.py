"""Aggregates of a row's group beside the row, whatever the share of the rows that one group holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one group that a task may meet, and the salts that a group has at least.
TASK_ROWS = 1 << 20
LEAST_SALTS = 64


def with_group(
    rows: DataFrame, by: list[str], found: dict[str, tuple[Callable[..., Column], Column]], spread_on: list[str], nulls: bool = False
) -> DataFrame:
    """``rows`` with a column ``name: (f, value)`` for each aggregate f(value) over the rows with equal ``by``.

    f combines its own results (min, max, sum). With ``nulls`` null is a value of ``by`` like others, without it
    rows with a null there are left out. Each group is dealt over salts by a hash of
    ``spread_on`` before anything moves by group, so no task meets a whole large group, and the lookup
    rows are at most as many as the rows. ``rows`` are read twice: pass a written table.
    """
    n = max(LEAST_SALTS, rows.count() // TASK_ROWS)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread_on), F.lit(n)).cast("int"))
    part = salted.groupBy(*by, "_salt").agg(*(f(c).alias(name) for name, (f, c) in found.items()))
    total = part.groupBy(*by).agg(*(f(name).alias(name) for name, (f, _) in found.items()))

    def joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        if not nulls:
            return left.join(right, on)
        other = right.select(*(F.col(c).alias(f"_of_{c}") for c in on), *(c for c in right.columns if c not in on))
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on]
        return left.join(other, same).drop(*(f"_of_{c}" for c in on))

    known = joined(part.select(*by, "_salt"), total, by)
    return joined(salted, known, [*by, "_salt"]).drop("_salt")

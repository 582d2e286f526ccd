"""Hashes that do not depend on partitioning, retries or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import literal


def hash_mod(key: str, salt: str, modulus: int) -> Column:
    """First 8 hex digits of md5(key column as text || salt), modulo ``modulus``."""
    digest = f"substr(md5(concat({key}, {literal(salt)})), 1, 8)"
    return F.expr(f"cast(conv({digest}, 16, 10) as bigint) % {modulus}L")


def hash60(key: Column, salt: str = "") -> Column:
    """First 15 hex digits of md5(key as text || salt): a whole number below 2**60."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def weighted_pick(draw: str, steps: list[tuple[int, object]], last: object) -> Column:
    """The value of the first step whose upper bound lies above the draw (0 to 99), else ``last``.

    Looked up in an array of 100 values, which keeps the generated code short.
    """
    values = [next((value for below, value in steps if number < below), last) for number in range(100)]
    return F.expr(f"get(array({', '.join(literal(v) for v in values)}), cast({draw} as int))")

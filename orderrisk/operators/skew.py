"""A join that a hot key cannot stall."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may hold. A key with more rows counts as hot.
TASK_ROWS = 1_000_000


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    spread_on: str,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Inner join of ``facts`` to the one ``lookup`` row of their key, whatever the size of each key.

    ``weight`` names the lookup column that counts the fact rows of the key. Keys above
    ``task_rows`` are hot: there are at most rows / task_rows of them, so the broadcast that hands
    their rows to the facts is bounded. Facts served that way are dealt over the shuffle by a hash
    of ``spread_on`` (they match nothing there, as the second join holds the other keys only), so
    that no task of the second join sees a large group. Both joins
    read the same lookup columns, so its aggregate runs once and its exchange is reused. The skew
    handling of adaptive execution does not cover this shape, since one side is an aggregate.
    """
    values = [name for name in lookup.columns if name not in keys]
    is_hot = F.col(weight) > task_rows
    hot = lookup.where(is_hot).select(*keys, F.struct(*values).alias("_hot"))
    cold = lookup.where(~is_hot).select(
        *keys, F.xxhash64(*keys).alias("_slot"), F.struct(*values).alias("_cold")
    )
    has_keys = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    dealt = (
        facts.where(has_keys)
        .join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_slot",
            F.when(F.col("_hot").isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(spread_on)),
        )
    )
    joined = dealt.join(cold, [*keys, "_slot"], "left").withColumn(
        "_found", F.coalesce("_hot", "_cold")
    )
    return joined.where(F.col("_found").isNotNull()).select(
        *facts.columns, *[F.col("_found")[name].alias(name) for name in values]
    )

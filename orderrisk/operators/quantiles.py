"""Exact quantiles in two narrow passes, without gathering the values of a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions.numbers import whole_div


def unit_counts(df: DataFrame, by: list[str], value: Column, unit: Column, *extra: Column) -> DataFrame:
    """Rows per group and unit (a coarse, order-preserving step of the value), combined map-side."""
    return (
        df.where(value.isNotNull())
        .groupBy(*by, unit.alias("_unit"))
        .agg(F.count(F.lit(1)).alias("_rows"), *extra)
    )


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: Column,
    unit: Column,
    shares: list[tuple[int, int]],
    units: DataFrame | None = None,
) -> DataFrame:
    """Order statistics around each share ``num/den``, for linear interpolation.

    Gives (by..., q, lo, hi, part): the quantile is ``lo + (hi - lo) * part / den``. The first pass
    counts rows per unit and finds the units that hold the wanted ranks; the second pass counts the
    distinct values of those units only. What is broadcast has 2 x len(shares) rows per group, and
    the windows run over units and over the distinct values of one unit, never over rows.
    """
    units = unit_counts(df, by, value, unit) if units is None else units
    ordered = Window.partitionBy(*by).orderBy("_unit")
    whole = Window.partitionBy(*by)
    placed = units.select(
        *by,
        "_unit",
        "_rows",
        (F.sum("_rows").over(ordered) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    wanted = []
    for number, (num, den) in enumerate(shares):
        position = (F.col("_total") - 1) * F.lit(num)
        low = whole_div(position, F.lit(den).cast("bigint"))
        part = position % F.lit(den)
        high = low + F.when(part > 0, 1).otherwise(0)
        for end, rank in (("lo", low), ("hi", high)):
            wanted.append(
                F.struct(
                    F.lit(number).alias("q"), F.lit(end).alias("end"), rank.alias("rank"), part.alias("part")
                )
            )
    targets = (
        placed.select(*by, "_unit", "_rows", "_before", F.inline(F.array(*wanted)))
        .where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_rows")))
        .select(
            *[F.col(name).alias(f"_t_{name}") for name in by],
            F.col("_unit").alias("_t_unit"),
            "q",
            "end",
            (F.col("rank") - F.col("_before")).alias("_offset"),
            "part",
        )
    )

    def same_unit(frame: DataFrame) -> Column:
        pairs = [frame[name] == F.col(f"_t_{name}") for name in by]
        return reduce(lambda a, b: a & b, pairs, frame["_unit"] == F.col("_t_unit"))

    named = df.where(value.isNotNull()).select(*by, unit.alias("_unit"), value.alias("_value"))
    held = targets.select(*[f"_t_{name}" for name in by], "_t_unit").distinct()
    values = (
        named.join(F.broadcast(held), same_unit(named), "left_semi")
        .groupBy(*by, "_unit", "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    in_unit = Window.partitionBy(*by, "_unit").orderBy("_value")
    values = values.withColumn("_upto", F.sum("_rows").over(in_unit))
    found = values.join(F.broadcast(targets), same_unit(values), "inner").where(
        (F.col("_offset") < F.col("_upto")) & (F.col("_offset") >= F.col("_upto") - F.col("_rows"))
    )
    return found.groupBy(*by, "q").agg(
        F.max(F.when(F.col("end") == "lo", F.col("_value"))).alias("lo"),
        F.max(F.when(F.col("end") == "hi", F.col("_value"))).alias("hi"),
        F.max("part").alias("part"),
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row ``median``; no row on input without values. Units are the whole numbers below."""
    value = F.col(column).cast("double")
    frame = df.select(F.lit(0).alias("_all"), value.alias("_v"))
    ends = exact_quantiles(frame, ["_all"], F.col("_v"), F.floor("_v"), [(1, 2)])
    return ends.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part") / F.lit(2.0)).alias("median"))


# Size of a sketch. At 4,096 a rank is off by at most 0.13 % of the rows (at 99 % confidence), whatever their number.
SKETCH_K = 4096


def sketched_quantiles(df: DataFrame, by: list[str], value: Column, shares: list[float], k: int = SKETCH_K) -> DataFrame:
    """(by..., share, quantile) in one pass: mergeable sketches of bounded size instead of exact order statistics.

    The value found has a rank within 2.3 / k**0.9 of ``share`` (at 99 % confidence). Nulls do not count; a group without
    values has no rows. Only the sketches are shuffled.
    """
    held = df.where(value.isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(value.cast("double"), k).alias("_sketch"))
    found = F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("_sketch", F.lit(float(s))).alias("quantile")) for s in shares])
    return held.select(*by, F.inline(found))

"""The numbers behind the exploratory charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions import text
from orderrisk.functions.numbers import (
    from_cents,
    mean_cents_as_money,
    percent_half_up,
    to_cents,
    whole_div,
)

from .quantiles import SKETCH_K, exact_quantiles, unit_counts
from .rules import MART_RULES, Rule, by_name

_LABELS = [0, 1]


def class_balance(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("orders"))
    total = F.sum("orders").over(Window.partitionBy())
    return counts.select(label, "orders", (F.col("orders") / total).alias("share"))


def histogram(
    df: DataFrame,
    column: str,
    bins: int,
    by: str = "is_fraud",
    clip: float | None = None,
    density: bool = False,
) -> DataFrame:
    """Equal bins over each label's own range; the last bin is closed, empty bins are kept.

    A value is put in the bin whose edges, as floating numbers, enclose it.
    """
    value = F.least(F.col(column), F.lit(clip)) if clip is not None else F.col(column)
    rows = df.where(F.col(by).isin(_LABELS) & F.col(column).isNotNull()).select(
        by, value.cast("double").alias("_v")
    )
    return _binned(rows.groupBy(by, "_v").agg(F.count(F.lit(1)).alias("_n")) if density else rows, by, bins, density)


def _binned(rows: DataFrame, by: str, bins: int, density: bool) -> DataFrame:
    weight = F.sum("_n") if density else F.count(F.lit(1))
    spread = F.max("_v") > F.min("_v")
    # There are two labels, so the ranges are two rows.
    ranges = rows.groupBy(by).agg(
        F.when(spread, F.min("_v")).otherwise(F.min("_v") - 0.5).alias("_lo"),
        F.when(spread, F.max("_v")).otherwise(F.max("_v") + 0.5).alias("_hi"),
        weight.alias("_total"),
    )
    step = (F.col("_hi") - F.col("_lo")) / F.lit(bins)

    def edge(number: Column) -> Column:
        return F.when(number == bins, F.col("_hi")).otherwise(number * step + F.col("_lo"))

    guess = F.least(
        F.lit(bins - 1),
        F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * F.lit(bins)).cast("int"),
    )
    guessed = rows.join(F.broadcast(ranges), by).withColumn("_g", guess)
    fitted = (
        F.when(F.col("_v") < edge(F.col("_g")), F.col("_g") - 1)
        .when((F.col("_v") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g"))
    )
    counts = guessed.groupBy(by, fitted.alias("bin")).agg(weight.alias("_rows"))
    spine = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    orders = F.coalesce("_rows", F.lit(0)).cast("bigint")
    columns = [
        F.col(by),
        F.col("bin"),
        edge(F.col("bin")).alias("lower"),
        edge(F.col("bin") + 1).alias("upper"),
        orders.alias("orders"),
    ]
    if density:
        width = edge(F.col("bin") + 1) - edge(F.col("bin"))
        columns.append((orders / width / F.col("_total")).alias("density"))
    return spine.join(F.broadcast(counts), [by, "bin"], "left").select(*columns)


def amount_describe(df: DataFrame, by: str = "is_fraud", column: str = "order_amount") -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per label, at two decimals.

    One pass keeps exact whole-number moments per label and whole currency unit; a second one looks
    up the order statistics inside the few units that hold the quartiles.
    """
    rows = df.where(F.col(by).isin(_LABELS)).select(by, to_cents(F.col(column)).alias("_c"))
    cents, unit = F.col("_c"), F.floor(F.col("_c") / 100).cast("bigint")
    rest = cents - unit * 100
    units = unit_counts(
        rows,
        [by],
        cents,
        unit,
        F.sum(rest).alias("_rest"),
        F.sum(rest * rest).alias("_rest2"),
        F.min(cents).alias("_min"),
        F.max(cents).alias("_max"),
    )

    def big(number: Column) -> Column:
        return number.cast("decimal(38,0)")

    n, u, rest1, rest2 = F.col("_rows"), F.col("_unit"), F.col("_rest"), F.col("_rest2")
    squares = big(u * u) * big(n * 10000) + big(u * 200) * big(rest1) + big(rest2)
    moments = units.groupBy(by).agg(
        F.sum(n).alias("n"),
        F.sum(u * n * 100 + rest1).alias("s1"),
        F.sum(squares.cast("decimal(38,0)")).alias("s2"),
        F.min("_min").alias("lo"),
        F.max("_max").alias("hi"),
    )
    spread = (big(F.col("n")) * F.col("s2") - big(F.col("s1")) * big(F.col("s1"))).cast("double")
    pairs = (F.col("n").cast("double") * (F.col("n") - 1).cast("double"))
    deviation = F.when(F.col("n") > 1, F.round(F.sqrt(spread / pairs) / 100, 2))
    ends = exact_quantiles(rows, [by], cents, unit, [(1, 4), (1, 2), (3, 4)], units=units)
    den = F.when(F.col("q") == 1, F.lit(2)).otherwise(F.lit(4)).cast("bigint")
    quarter = F.col("lo") * den + (F.col("hi") - F.col("lo")) * F.col("part")
    money = from_cents(whole_div(quarter * 2 + den, den * 2))
    quartiles = ends.groupBy(by).agg(
        *[F.max(F.when(F.col("q") == i, money)).alias(name) for i, name in enumerate(["q25", "q50", "q75"])]
    )
    stats = moments.select(
        by,
        F.col("n").alias("count"),
        mean_cents_as_money(F.col("s1"), F.col("n")).alias("mean"),
        deviation.alias("std"),
        from_cents(F.col("lo")).alias("min"),
        from_cents(F.col("hi")).alias("max"),
    )
    return stats.join(F.broadcast(quartiles), by).select(
        by, "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def rate_by(df: DataFrame, column: str, label: str = "is_fraud") -> DataFrame:
    """Mean label and rows per value, highest rate first."""
    return (
        df.groupBy(column)
        .agg((F.sum(label) / F.count(label)).alias("fraud_rate"), F.count(label).alias("orders"))
        .where(F.col(column).isNotNull())
        .orderBy(F.col("fraud_rate").desc_nulls_last(), column)
    )


def rate_by_hour(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rate per hour in percent, with the unweighted mean of the hourly rates."""
    hourly = (
        df.where(F.col("order_hour").isNotNull())
        .groupBy("order_hour")
        .agg((F.sum(label) / F.count(label) * 100).alias("fraud_rate_pct"))
    )
    mean = F.round(F.avg("fraud_rate_pct").over(Window.partitionBy()), 9)
    return hourly.withColumn("mean_of_hours_pct", mean)


def rate_by_age(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rate per account-age bucket; empty buckets stay, negative ages are in none."""
    age = F.col("account_age_days")
    sums = []
    for number, (_, low, high) in enumerate(fixed.AGE_BUCKETS):
        inside = (age >= low) if high is None else (age >= low) & (age < high)
        sums.append(F.sum(F.when(inside, F.col(label))).alias(f"p{number}"))
        sums.append(F.count(F.when(inside, F.col(label))).alias(f"n{number}"))
    lines = [
        F.struct(
            F.lit(name).alias("age_bucket"),
            (F.col(f"p{number}") / F.nullif(F.col(f"n{number}"), F.lit(0))).alias("fraud_rate"),
            F.col(f"n{number}").alias("orders"),
        )
        for number, (name, _, _) in enumerate(fixed.AGE_BUCKETS)
    ]
    return df.agg(*sums).select(F.inline(F.array(*lines)))


def rule_quality(df: DataFrame, rules: list[Rule] = MART_RULES, label: str = "is_fraud") -> DataFrame:
    """Hit rate, precision and recall of each rule in percent, next to the base rate; one scan."""
    named = by_name(rules)
    names = list(fixed.EXPLORE_RULE_LABELS)
    base = df.selectExpr(
        "count(1) as rows",
        f"sum({label}) as fraud",
        *[f"{named[name].hits} as hit_{name}" for name in names],
        *[f"count_if(({named[name].condition}) and {label} = 1) as caught_{name}" for name in names],
    )
    lines = [
        F.struct(
            F.lit(fixed.EXPLORE_RULE_LABELS[name]).alias("rule"),
            percent_half_up(F.col(f"hit_{name}"), F.col("rows")).alias("hit_rate_pct"),
            percent_half_up(F.col(f"caught_{name}"), F.col(f"hit_{name}")).alias("precision_pct"),
            percent_half_up(F.col(f"caught_{name}"), F.col("fraud")).alias("recall_pct"),
            percent_half_up(F.col("fraud"), F.col("rows"), 2).alias("base_rate_pct"),
        )
        for name in names
    ]
    return base.select(F.inline(F.array(*lines)))


def amount_describe_sketched(df: DataFrame, by: str = "is_fraud", column: str = "order_amount") -> DataFrame:
    """:func:`amount_describe` in one pass, for tables on which a second one costs too much: quartiles come from sketches.

    Their ranks are off by at most 0.13 % of a label's rows (see ``quantiles.SKETCH_K``); the other numbers are as there.
    """
    rows = df.where(F.col(by).isin(_LABELS))
    cents = to_cents(F.col(column))
    wide = cents.cast("decimal(38,0)")
    plain = rows.groupBy(by).agg(
        F.count(cents).alias("n"),
        F.sum(wide).alias("s"),
        F.sum(wide * wide).alias("ss"),
        F.min(cents).alias("lo"),
        F.max(cents).alias("hi"),
        F.kll_sketch_agg_double(cents.cast("double") / 100, SKETCH_K).alias("sketch"),
    )
    n = F.col("n").cast("double")
    apart = (F.col("ss").cast("double") - F.col("s").cast("double") * F.col("s").cast("double") / n) / F.nullif(n - 1, F.lit(0.0))
    quarters = [F.round(F.kll_sketch_get_quantile_double("sketch", F.lit(q)), 2).alias(name) for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    return plain.where("n > 0").select(
        by,
        F.col("n").alias("count"),
        F.round(F.col("s").cast("double") / n / 100, 2).alias("mean"),
        F.round(F.sqrt(apart) / 100, 2).alias("std"),
        from_cents(F.col("lo")).alias("min"),
        *quarters,
        from_cents(F.col("hi")).alias("max"),
    )



def correlations(df: DataFrame, columns: list[str] = fixed.CORRELATION_COLUMNS) -> DataFrame:
    """The Pearson matrix as (feature_a, feature_b, correlation) rows, over pairwise complete rows.

    One pass takes the sums of all columns and products once per null pattern (which columns of a
    row are null; there are at most 2^8 patterns, and mostly one). Values are taken as deviations from
    the column's mean, found in a pass before, so that large values lose no digits. A pair then adds up the patterns
    in which both of its columns are there. This costs a few additions per row, where a separate
    correlation aggregate per pair costs two divisions per pair and row.
    """
    size = len(columns)
    pairs = [(a, b) for a in range(size) for b in range(a, size)]
    pattern = " + ".join(f"if({column} is null, {1 << i}, 0)" for i, column in enumerate(columns))
    # One row of numbers.
    found = df.selectExpr(
        *[f"{kind}(cast({column} as double)) as {kind}{i}" for i, column in enumerate(columns) for kind in ("avg", "min", "max")]
    ).first()
    # A constant is its own mean exactly, where an average may be off by a last digit.
    means = [found[f"min{i}"] if found[f"min{i}"] == found[f"max{i}"] else found[f"avg{i}"] for i in range(size)]
    # Means that are no numbers (a NaN or infinite value is about) leave the pairs of that column without a correlation.
    values = [
        F.coalesce(F.col(column).cast("double") - F.lit(float(means[i] or 0.0)), F.lit(0.0)).alias(f"v{i}") for i, column in enumerate(columns)
    ]
    sums = (
        df.select(F.expr(pattern).alias("pattern"), *values)
        .groupBy("pattern")
        .agg(
            F.expr("count(1) as n"),
            *[F.expr(f"sum(v{i}) as s{i}") for i in range(size)],
            *[F.expr(f"sum(v{a} * v{b}) as p{a}_{b}") for a, b in pairs],
        )
    )
    lines = []
    for a, b in pairs:
        there = f"(pattern & {(1 << a) | (1 << b)}) = 0"
        moments = {"n": "n", "sa": f"s{a}", "sb": f"s{b}", "aa": f"p{a}_{a}", "bb": f"p{b}_{b}", "ab": f"p{a}_{b}"}
        ends = {"a": str(a), "b": str(b)}
        lines.append({**ends, **{key: f"if({there}, {sql}, null)" for key, sql in moments.items()}})
    totals = (
        sums.selectExpr(text.rows(lines))
        .groupBy("a", "b")
        .agg(*[F.expr(f"cast(sum({key}) as double) as {key}") for key in ("n", "sa", "sb", "aa", "bb", "ab")])
    )
    names = f"array({', '.join(text.literal(column) for column in columns)})"
    left, right = "(aa - sa * sa / n)", "(bb - sb * sb / n)"
    value = (
        f"case when {left} > 0 and {right} > 0 then"
        f" if(a = b and not isnan({left}), 1D, round((ab - sa * sb / n) / sqrt({left} * {right}), 6)) end"
    )
    # The matrix is symmetric: every pair off the diagonal gives two rows.
    both = "if(a = b, array(struct(a as i, b as j)), array(struct(a as i, b as j), struct(b as i, a as j)))"
    return (
        totals.where("n > 0")
        .selectExpr(f"inline({both})", f"{value} as correlation")
        .selectExpr(f"{names}[i] as feature_a", f"{names}[j] as feature_b", "correlation")
    )

"""The scored mart and the variant pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed

from .customers import daily_with_profile, order_velocity
from .rules import MART_RULES, VARIANT_RULES, Rule, total_score
from .skew import TASK_ROWS, spread_join
from .staging import stage


def risk_tier(score: Column, floors: list[tuple[int, str]] = fixed.TIER_FLOORS) -> Column:
    tier = None
    for floor, name in floors:
        tier = (F if tier is None else tier).when(score >= floor, F.lit(name))
    return tier.otherwise(F.lit(fixed.LOWEST_TIER))


def fraud_flag(score: Column, flag_at: int = fixed.FLAG_AT) -> Column:
    return F.when(score >= flag_at, F.lit(1)).otherwise(F.lit(0))


def fct_fraud_signals(
    stg: DataFrame,
    rules: list[Rule] = MART_RULES,
    min_orders: int = fixed.HIGH_VELOCITY_ORDERS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """The scored mart: staging, velocity, customer profile, score, flag and tier.

    Needs unique order ids (check with ``quality.unique`` first): then joining velocity back by
    order id is the same as joining the daily counts by customer and day, and one join carries
    both the velocity and the profile, so the wide order rows are shuffled once.
    """
    enriched = spread_join(
        stg,
        daily_with_profile(stg),
        ["customer_id", "order_date"],
        weight="orders_on_day",
        spread_on="order_id",
        task_rows=task_rows,
    )
    signals = enriched.withColumn("high_velocity", F.col("orders_on_day") >= min_orders)
    scored = signals.select(
        *stg.columns,
        "orders_on_day",
        "high_velocity",
        "customer_avg_order_amount",
        "customer_ip_mismatch_count",
        total_score(rules).alias("risk_score"),
    )
    return scored.withColumns(
        {"fraud_flag": fraud_flag(F.col("risk_score")), "risk_tier": risk_tier(F.col("risk_score"))}
    )


def score_variant(
    stg: DataFrame,
    rules: list[Rule] = VARIANT_RULES,
    min_orders: int = fixed.HIGH_VELOCITY_ORDERS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """The variant pipeline: other rules, no tier, twelve columns."""
    velocity = spread_join(
        stg,
        stg.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("orders_on_day")),
        ["customer_id", "order_date"],
        weight="orders_on_day",
        spread_on="order_id",
        task_rows=task_rows,
    ).withColumn("high_velocity", F.col("orders_on_day") >= min_orders)
    return velocity.select(
        "order_id",
        "customer_id",
        "order_amount",
        "payment_method",
        "product_category",
        "is_new_customer",
        "order_hour",
        "country_mismatch",
        "ip_mismatch",
        "high_velocity",
        total_score(rules).alias("risk_score"),
    ).withColumn("fraud_flag", fraud_flag(F.col("risk_score")))


def boundary_orders(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """Every order replays one boundary case, dealt by its id, as the only order of its customer."""
    base, cases = fixed.BOUNDARY_BASE, fixed.BOUNDARY_CASES
    case = F.pmod(F.col(key), F.lit(len(cases))) + 1
    with_case = orders.select(
        F.col(key),
        (F.col(key) + 9000).alias("customer_id"),
        case.cast("int").alias("case_id"),
    )

    def column(name: str) -> Column:
        value = F.lit(base[name])
        for number, (changes, _, _) in enumerate(cases, start=1):
            if name in changes:
                value = F.when(F.col("case_id") == number, F.lit(changes[name])).otherwise(value)
        return value.alias(name)

    return with_case.select(key, "customer_id", "case_id", *[column(name) for name in base])


def expected_boundary(case_id: Column) -> tuple[Column, Column]:
    """Expected score and flag of a boundary case."""
    score, flag = F.lit(None).cast("int"), F.lit(None).cast("int")
    for number, (_, want_score, want_flag) in enumerate(fixed.BOUNDARY_CASES, start=1):
        score = F.when(case_id == number, F.lit(want_score)).otherwise(score)
        flag = F.when(case_id == number, F.lit(want_flag)).otherwise(flag)
    return score, flag


def boundary_report(orders: DataFrame) -> DataFrame:
    """Every order replays a boundary case; per case, the score and how many orders agree with it."""
    scored = score_variant(stage(boundary_orders(orders)))
    case = (F.pmod("order_id", F.lit(len(fixed.BOUNDARY_CASES))) + 1).cast("int")
    want_score, want_flag = expected_boundary(F.col("case_id"))
    agrees = (F.col("risk_score") == want_score) & (F.col("fraud_flag") == want_flag)
    return (
        scored.withColumn("case_id", case)
        .groupBy("case_id")
        .agg(
            F.max("risk_score").alias("risk_score"),
            F.max("fraud_flag").alias("fraud_flag"),
            F.count(F.lit(1)).alias("orders"),
            F.count(F.when(agrees, F.lit(1))).alias("as_expected"),
        )
    )


__all__ = [
    "boundary_orders",
    "boundary_report",
    "expected_boundary",
    "fct_fraud_signals",
    "fraud_flag",
    "order_velocity",
    "risk_tier",
    "score_variant",
]

"""Aggregates per customer and day, and per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.numbers import mean_cents_as_money, to_cents

from .skew import TASK_ROWS, spread_join


def daily_order_counts(stg: DataFrame) -> DataFrame:
    return stg.groupBy("customer_id", "order_date").agg(F.count(F.lit(1)).alias("orders_on_day"))


def order_velocity(
    stg: DataFrame, min_orders: int = fixed.HIGH_VELOCITY_ORDERS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Orders of the same customer on the same day, per order; null customers or dates drop out."""
    joined = spread_join(
        stg.select("order_id", "customer_id", "order_date"),
        daily_order_counts(stg),
        ["customer_id", "order_date"],
        weight="orders_on_day",
        spread_on="order_id",
        task_rows=task_rows,
    )
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        "orders_on_day",
        (F.col("orders_on_day") >= min_orders).alias("high_velocity"),
    )


def risk_profile(stg: DataFrame) -> DataFrame:
    """Eight aggregates per customer.

    The two distinct counts run as hash aggregates over (customer, value) pairs, so no task ever
    holds the set of values of a customer.
    """
    cents = to_cents(F.col("order_amount"))
    return (
        stg.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            mean_cents_as_money(F.sum(cents), F.count(cents)).alias("avg_order_amount"),
            F.round(F.max("order_amount"), 2).alias("max_order_amount"),
            F.min("account_age_days").alias("account_age_days"),
            F.bool_or("is_new_customer").alias("is_new_customer"),
            F.count_distinct("product_category").alias("distinct_categories"),
            F.count_distinct("payment_method").alias("distinct_payment_methods"),
            F.sum(F.when(F.col("ip_mismatch"), 1).otherwise(0)).alias("ip_mismatch_count"),
        )
    )


def daily_with_profile(stg: DataFrame) -> DataFrame:
    """One row per customer and day: orders that day, and the customer's average and IP mismatches.

    Both aggregates come out of one pass over the orders: the customer totals are sums over the
    customer's days. A customer has at most as many rows here as there are dates, so the window
    stays small however many orders the customer placed.
    """
    cents = to_cents(F.col("order_amount"))
    daily = stg.groupBy("customer_id", "order_date").agg(
        F.count(F.lit(1)).alias("orders_on_day"),
        F.sum(cents).alias("_cents"),
        F.count(cents).alias("_amounts"),
        F.sum(F.when(F.col("ip_mismatch"), 1).otherwise(0)).alias("_mismatches"),
    )
    customer = Window.partitionBy("customer_id")
    return daily.select(
        "customer_id",
        "order_date",
        "orders_on_day",
        mean_cents_as_money(F.sum("_cents").over(customer), F.sum("_amounts").over(customer)).alias(
            "customer_avg_order_amount"
        ),
        F.sum("_mismatches").over(customer).alias("customer_ip_mismatch_count"),
    )

"""Typed staging of the order feed."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stage(orders: DataFrame) -> DataFrame:
    """13 feed columns to 15: strict casts, and two mismatch flags that stay null on null input.

    The ids keep the type of their feed. The label is taken along where the feed has one.
    """
    columns = [
        "order_id",
        "customer_id",
        "cast(order_date as date) as order_date",
        "cast(order_hour as int) as order_hour",
        "cast(order_amount as double) as order_amount",
        "payment_method",
        "product_category",
        "billing_country",
        "shipping_country",
        "ip_country",
        "cast(is_new_customer as boolean) as is_new_customer",
        "cast(account_age_days as int) as account_age_days",
        "billing_country <> shipping_country as country_mismatch",
        "ip_country <> billing_country as ip_mismatch",
    ]
    if "is_fraud" in orders.columns:
        columns.append("cast(is_fraud as int) as is_fraud")
    return orders.selectExpr(*columns)

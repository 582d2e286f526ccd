"""Order and card feeds derived from the ``events`` table, row by row and without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.functions.hashing import hash_mod, weighted_pick


def _drawn(spark: SparkSession, sf_dir: str, salts: dict[str, int]) -> DataFrame:
    """The events with one drawn number per salt, so that each hash is computed once per row."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    draws = {f"_{salt}": hash_mod("_text", salt, modulus) for salt, modulus in salts.items()}
    return events.withColumn("_text", F.col("event_id").cast("string")).withColumns(draws)


def _draw(salt: str) -> Column:
    return F.col(f"_{salt}")


_ORDER_SALTS = {"pay": 100, "cat": 100, "bill": 100, "ship": 100, "ip": 100, "new": 100}
_CARD_SALTS = {
    "prod": 100,
    "cn": 100,
    "cs": 100,
    "c4": 100,
    "a2": 100,
    "pd": 100,
    "rd": 100,
    "d1n": 100,
    "d1": 800,
    "fraud": 1000,
}


def _order_columns(payment, category) -> list:
    billing = weighted_pick("_bill", [(60, "US"), (75, "CA"), (85, "GB"), (93, "AU")], "DE")
    shipping = weighted_pick("_ship", [(65, "US"), (78, "CA"), (87, "GB"), (94, "AU")], "DE")
    ip = weighted_pick("_ip",
        [(55, "US"), (65, "CA"), (73, "GB"), (79, "AU"), (84, "DE"), (89, "NG"), (95, "RO")],
        "BR",
    )
    is_new = _draw("new") < 20
    age = F.when(is_new, hash_mod("_text", "age", 29) + 1).otherwise(
        hash_mod("_text", "age", 1795) + 30
    )
    return [
        F.col("event_id").alias("order_id"),
        (F.col("user_id") * 4 + F.col("event_id") % 4).alias("customer_id"),
        F.to_date("ts").alias("order_date"),
        F.hour("ts").alias("order_hour"),
        (F.col("value") * F.lit(2.0)).alias("order_amount"),
        payment.alias("payment_method"),
        category.alias("product_category"),
        billing.alias("billing_country"),
        shipping.alias("shipping_country"),
        ip.alias("ip_country"),
        is_new.alias("is_new_customer"),
        age.cast("int").alias("account_age_days"),
    ]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13-column order feed; its label depends on age, amount and IP mismatch."""
    payment = weighted_pick("_pay", [(45, "visa"), (80, "mastercard"), (92, "discover")], "american express"
    )
    category = weighted_pick("_cat",
        [(20, "Electronics"), (55, "Clothing"), (70, "Travel"), (90, "Home & Garden")],
        "Services",
    )
    feed = _drawn(spark, sf_dir, _ORDER_SALTS).select(*_order_columns(payment, category))
    risk = (
        F.lit(10)
        + F.when(F.col("account_age_days") < 30, 60).otherwise(0)
        + F.when(F.col("order_amount") >= 150, 40).otherwise(0)
        + F.when(F.col("ip_country") != F.col("billing_country"), 30).otherwise(0)
    )
    is_fraud = hash_mod("order_id", "fraud", 1000) < risk
    return feed.withColumn("is_fraud", F.when(is_fraud, 1).otherwise(0))


def stress_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unlabelled feed in the vocabulary of the variant rules."""
    payment = weighted_pick("_pay", [(50, "credit_card"), (75, "debit_card"), (95, "paypal")], "crypto"
    )
    category = weighted_pick("_cat",
        [(20, "electronics"), (55, "clothing"), (70, "gift_cards"), (80, "luxury")],
        "home",
    )
    return _drawn(spark, sf_dir, _ORDER_SALTS).select(*_order_columns(payment, category))


def card_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw card feed, with missing values, unknown codes, half days and single-use cards."""
    ts = F.col("ts")
    seconds = (
        F.datediff(ts, F.lit("2024-01-01").cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
    )
    card = (
        F.when(_draw("cn") < 2, F.lit(None).cast("double"))
        .when(_draw("cs") < 3, (F.col("event_id") + 100000).cast("double"))
        .otherwise((F.col("user_id") * 4 + F.col("event_id") % 4).cast("double"))
    )
    domains = [
        (40, "gmail.com"),
        (50, "yahoo.com"),
        (56, "anonymous.com"),
        (61, "web.de"),
        (66, "yahoo.co.jp"),
        (71, "hotmail.co.uk"),
        (75, "yahoo.com.mx"),
        (79, "hotmail.es"),
        (83, "yahoo.fr"),
        (86, "uol.com.br"),
    ]
    return _drawn(spark, sf_dir, _CARD_SALTS).select(
        F.col("event_id").alias("TransactionID"),
        seconds.cast("bigint").alias("TransactionDT"),
        # A third decimal, as card feeds have it.
        ((F.rint(F.col("value") * 100.0) * 10.0 + F.col("event_id") % 10) / 1000.0).alias("TransactionAmt"),
        weighted_pick("_prod", [(60, "W"), (72, "C"), (80, "R"), (88, "H"), (96, "S"), (98, "X")], None
        ).alias("ProductCD"),
        card.alias("card1"),
        weighted_pick("_c4",
            [(55, "visa"), (85, "mastercard"), (92, "discover"), (97, "american express")],
            None,
        ).alias("card4"),
        weighted_pick("_a2",
            [(70, 87.0), (75, 60.0), (80, 96.0), (84, 32.0), (87, 65.0), (90, 999.0)],
            None,
        ).alias("addr2"),
        weighted_pick("_pd", domains, None).alias("P_emaildomain"),
        weighted_pick("_rd", domains, None).alias("R_emaildomain"),
        F.when(_draw("d1n") < 5, F.lit(None).cast("double"))
        .otherwise(_draw("d1") / F.lit(2.0))
        .alias("D1"),
        F.when(_draw("fraud") < 35, 1).otherwise(0).alias("isFraud"),
    )

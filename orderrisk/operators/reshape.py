"""The raw card feed in the shape of the order feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.lookups import email_country, from_dict
from orderrisk.functions.text import literal

from .quantiles import exact_median

_DAY = 86400


def impute_median(df: DataFrame, column: str) -> Column:
    """The column with nulls replaced by its exact median, rounded half-even to int.

    The median is a scalar subquery: computed once, no join.
    """
    median = exact_median(df, column).scalar()
    return F.bround(F.coalesce(F.col(column), median), 0).cast("int")


def singleton_flag(df: DataFrame, key: str, row_id: str, flag: str) -> DataFrame:
    """Adds 1 where ``key`` occurs on one row only, else 0 (null keys are 0).

    A key that occurs once knows its row, so the join back is on (key, row id). That spreads the
    rows of a frequent or missing key over the whole shuffle, which a join on the key would not.
    """
    single = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_uses"), F.min(row_id).alias("_row"))
        .where(F.col("_uses") == 1)
        .select("_key", "_row", F.lit(1).alias("_single"))
    )
    joined = df.join(
        single, (F.col(key) == F.col("_key")) & F.col(row_id).eqNullSafe(F.col("_row")), "left"
    )
    return joined.withColumn(flag, F.coalesce("_single", F.lit(0))).drop("_key", "_row", "_single")


def reshape_card_txns(raw: DataFrame) -> DataFrame:
    """11 card columns to the 13 columns of the order feed.

    All that a row can tell by itself is worked out first, so that the shuffle for the single-use
    cards carries short codes instead of raw fields.
    """
    seconds = "TransactionDT"
    rows = raw.select(
        F.col("TransactionID").alias("_id"),
        F.col("card1").alias("_card"),
        F.expr("cast(TransactionID as string) as order_id"),
        F.expr("concat('C', cast(cast(coalesce(card1, 0D) as bigint) as string)) as customer_id"),
        F.expr(
            f"date_add(date {literal(fixed.CARD_FEED_DAY_ZERO)}, cast(floor({seconds} / {_DAY}) as int))"
        ).alias("order_date"),
        F.expr(f"cast(pmod({seconds}, {_DAY}) div 3600 as int) as order_hour"),
        # Scaled, rounded to even and scaled back, as the feed's own tools round.
        (F.rint(F.col("TransactionAmt") * 100.0) / 100.0).alias("order_amount"),
        F.coalesce("card4", F.lit(fixed.DEFAULT_PAYMENT)).alias("payment_method"),
        from_dict("ProductCD", fixed.PRODUCT_BY_CODE, fixed.DEFAULT_PRODUCT).alias("product_category"),
        from_dict("addr2", fixed.COUNTRY_BY_ADDRESS_CODE, fixed.DEFAULT_COUNTRY).alias("billing_country"),
        email_country("R_emaildomain").alias("shipping_country"),
        email_country("P_emaildomain").alias("ip_country"),
        "D1",
        F.col("isFraud").alias("is_fraud"),
    )
    flagged = singleton_flag(rows, "_card", "_id", "is_new_customer")
    return flagged.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_hour",
        "order_amount",
        "payment_method",
        "product_category",
        "billing_country",
        "shipping_country",
        "ip_country",
        "is_new_customer",
        impute_median(raw, "D1").alias("account_age_days"),
        "is_fraud",
    )


def reshape_profile(orders: DataFrame, top: int = 4) -> DataFrame:
    """(measure, item, value): rows, fraud rate, new-customer rate, top countries, categories.

    One pass over the orders; the grouping sets and the ranking run on the small grouped table.
    """
    small = orders.groupBy("billing_country", "product_category").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("is_fraud").alias("fraud"),
        F.sum("is_new_customer").alias("new"),
    )
    sets = small.groupingSets(
        [("billing_country",), ("product_category",), ()], "billing_country", "product_category"
    ).agg(
        F.sum("rows").alias("rows"),
        F.sum("fraud").alias("fraud"),
        F.sum("new").alias("new"),
        F.grouping("billing_country").alias("no_country"),
        F.grouping("product_category").alias("no_category"),
    )
    rank = F.row_number().over(
        Window.partitionBy("no_country", "no_category").orderBy(
            F.col("rows").desc(), F.col("billing_country").asc_nulls_last()
        )
    )
    ranked = sets.withColumn("rank", rank).where((F.col("no_country") == 1) | (F.col("rank") <= top))

    def line(measure: str, item: Column, value: Column) -> Column:
        return F.struct(
            F.lit(measure).alias("measure"), item.alias("item"), value.cast("double").alias("value")
        )

    none = F.lit(None).cast("string")
    rows = F.nullif(F.col("rows"), F.lit(0))
    lines = (
        F.when(F.col("no_country") == 0, F.array(line("billing_country", F.col("billing_country"), F.col("rows"))))
        .when(F.col("no_category") == 0, F.array(line("product_category", F.col("product_category"), F.col("rows"))))
        .otherwise(
            F.array(
                line("rows", none, F.coalesce("rows", F.lit(0))),
                line("fraud_rate", none, F.col("fraud") / rows),
                line("new_customer_rate", none, F.col("new") / rows),
            )
        )
    )
    return ranked.select(F.inline(lines))

"""The tables behind the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.numbers import (
    count_where,
    percent_half_up,
    ratio_half_up,
    to_cents,
    whole_div,
)

from .rules import MART_RULES, Rule, by_name, hits_as_rows


def _rows() -> Column:
    return F.count(F.lit(1))


def _inline(*structs: Column) -> Column:
    return F.inline(F.array(*structs))


def summary(mart: DataFrame) -> DataFrame:
    """The headline row: one scan, one aggregate."""
    flagged = F.col("fraud_flag") == 1
    base = mart.agg(
        _rows().alias("total_orders"),
        F.sum("fraud_flag").alias("flagged_orders"),
        *[
            F.sum(F.when(F.col("risk_tier") == tier, 1).otherwise(0)).alias(name)
            for tier, name in (
                ("high", "high_risk"),
                ("medium", "medium_risk"),
                ("low", "low_risk"),
                ("none", "no_risk"),
            )
        ],
        F.sum(F.when(flagged, to_cents(F.col("order_amount"))).otherwise(0)).alias("_cents"),
        F.sum(F.when(flagged, F.col("risk_score"))).alias("_score"),
        F.count(F.when(flagged, F.col("risk_score"))).alias("_scored"),
    )
    return base.select(
        "total_orders",
        "flagged_orders",
        percent_half_up(F.col("flagged_orders"), F.col("total_orders")).alias("fraud_rate_pct"),
        "high_risk",
        "medium_risk",
        "low_risk",
        "no_risk",
        whole_div(F.col("_cents") + 50, F.lit(100).cast("bigint")).cast("double").alias("flagged_amount"),
        ratio_half_up(F.col("_score"), F.col("_scored"), 1).alias("avg_risk_score"),
    )


def tier_distribution(mart: DataFrame) -> DataFrame:
    """Orders and share per tier, and the share of this and all riskier tiers."""
    tiers = list(reversed(fixed.RISK_TIERS))
    counts = mart.agg(
        _rows().alias("total"),
        *[count_where(F.col("risk_tier") == tier).alias(f"n_{tier}") for tier in tiers],
    )
    upto = F.lit(0)
    lines = []
    for rank, tier in enumerate(tiers, start=1):
        upto = upto + F.col(f"n_{tier}")
        lines.append(
            F.struct(
                F.lit(rank).alias("tier_rank"),
                F.lit(tier).alias("risk_tier"),
                F.col(f"n_{tier}").alias("orders"),
                percent_half_up(F.col(f"n_{tier}"), F.col("total")).alias("share_pct"),
                percent_half_up(upto, F.col("total"), 2).alias("cumulative_pct"),
            )
        )
    return counts.select(_inline(*lines))


def rule_hits(mart: DataFrame, rules: list[Rule] = MART_RULES) -> DataFrame:
    """Orders per rule, most hits first: one scan for all rules."""
    hits = hits_as_rows(mart, rules, fixed.REPORT_RULE_LABELS)
    return hits.orderBy(F.col("hits").desc(), "rule")


def rule_hits_scaled(mart: DataFrame, rules: list[Rule] = MART_RULES) -> DataFrame:
    """Hits as a share of all orders, and relative to the rule with the most hits."""
    named = by_name(rules)
    names = list(fixed.REPORT_RULE_LABELS)
    base = mart.selectExpr(
        "count(1) as total", *[f"{named[name].hits} as {name}" for name in names]
    ).withColumn("most", F.greatest(*names))
    lines = [
        F.struct(
            F.lit(fixed.REPORT_RULE_LABELS[name]).alias("rule"),
            F.col(name).alias("hits"),
            percent_half_up(F.col(name), F.col("total")).alias("pct_total"),
            F.coalesce(percent_half_up(F.col(name), F.col("most")), F.lit(0.0)).alias("bar_width"),
        )
        for name in names
    ]
    return base.select(_inline(*lines)).orderBy(F.col("hits").desc(), "rule")


def ml_metric_cards(metrics: DataFrame) -> DataFrame:
    """The six metrics in fixed order, as text; a missing one reads N/A."""
    known = metrics.agg(
        *[
            F.max(F.when(F.col("metric") == name, F.col("value"))).cast("string").alias(name)
            for name in fixed.METRIC_NAMES
        ]
    )
    lines = [
        F.struct(
            F.lit(name).alias("metric"),
            F.coalesce(F.col(name), F.lit(fixed.MISSING_METRIC)).alias("value"),
        )
        for name in fixed.METRIC_NAMES
    ]
    return known.select(_inline(*lines))


def ml_summary(mart: DataFrame, preds: DataFrame) -> DataFrame:
    """Orders flagged by the model, their share, and orders flagged by both. 0 when there are none."""
    joined = preds.select("order_id", "ml_fraud_flag").join(
        mart.select("order_id", "fraud_flag"), "order_id", "inner"
    )
    both = (F.col("ml_fraud_flag") == 1) & (F.col("fraud_flag") == 1)
    base = joined.agg(
        _rows().alias("rows"),
        F.coalesce(F.sum("ml_fraud_flag"), F.lit(0)).cast("bigint").alias("ml_flagged"),
        count_where(both).alias("both_flagged"),
    )
    rate = F.coalesce(percent_half_up(F.col("ml_flagged"), F.col("rows")), F.lit(0.0))
    return base.select("ml_flagged", rate.alias("ml_flag_rate"), "both_flagged")


_FLAGGED_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_amount",
    "payment_method",
    "product_category",
    "billing_country",
    "shipping_country",
    "ip_country",
    "risk_score",
    "risk_tier",
]


def flagged_top(mart: DataFrame, preds: DataFrame, n: int = fixed.TOP_FLAGGED) -> DataFrame:
    """The flagged orders with the highest model probability (missing counts as 0).

    The large join carries ids and probabilities only; the other columns are fetched for the top n.
    """
    order = [F.col("ml_fraud_prob").desc(), F.col("order_id").asc()]
    top = (
        mart.where(F.col("fraud_flag") == 1)
        .select("order_id")
        .join(preds.select("order_id", "ml_fraud_prob", "ml_fraud_flag"), "order_id", "left")
        .select(
            "order_id",
            F.coalesce("ml_fraud_prob", F.lit(0.0)).alias("ml_fraud_prob"),
            F.coalesce("ml_fraud_flag", F.lit(0)).alias("ml_fraud_flag"),
        )
        .orderBy(*order)
        .limit(n)
        .distinct()
    )
    wide = mart.where(F.col("fraud_flag") == 1).select(*_FLAGGED_COLUMNS)
    return wide.join(F.broadcast(top), "order_id", "inner").orderBy(*order).limit(n)


def flagged_bars(top: DataFrame) -> DataFrame:
    """Display columns: score as a share of the maximum, date as text."""
    return top.select(
        *[name for name in top.columns if name not in ("order_date", "risk_score")],
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
        F.col("risk_score").cast("int").alias("risk_score"),
        percent_half_up(F.col("risk_score"), F.lit(fixed.MAX_SCORE)).alias("score_bar_pct"),
    )


def flagged_filter(
    top: DataFrame, tier: str | None = None, payment: str | None = None, category: str | None = None
) -> DataFrame:
    """The rows that fit every given choice, with the number of rows shown."""
    chosen = {"risk_tier": tier, "payment_method": payment, "product_category": category}
    shown = top
    for name, value in chosen.items():
        if value:
            shown = shown.where(F.col(name) == value)
    return shown.withColumn("visible", F.count(F.lit(1)).over(Window.partitionBy()))


def export_rows(top: DataFrame) -> DataFrame:
    """The flagged table as the text fields of the CSV export, headers included."""
    fields = [
        F.col("order_id").cast("string"),
        F.col("customer_id").cast("string"),
        F.date_format("order_date", "yyyy-MM-dd"),
        F.format_string("$%.2f", F.col("order_amount")),
        F.col("payment_method"),
        F.col("product_category"),
        F.col("billing_country"),
        F.col("shipping_country"),
        F.col("ip_country"),
        F.concat(F.bround(F.col("ml_fraud_prob") * 100, 0).cast("int").cast("string"), F.lit("%")),
        F.col("risk_score").cast("int").cast("string"),
        F.col("risk_tier"),
    ]
    return top.select(*[f.alias(name) for f, name in zip(fields, fixed.EXPORT_HEADERS, strict=True)])


def sorted_export(top: DataFrame) -> DataFrame:
    return export_rows(top.orderBy(F.col("ml_fraud_prob").desc(), F.col("order_id").asc()))


__all__ = [
    "export_rows",
    "flagged_bars",
    "flagged_filter",
    "flagged_top",
    "ml_metric_cards",
    "ml_summary",
    "rule_hits",
    "rule_hits_scaled",
    "sorted_export",
    "summary",
    "tier_distribution",
]

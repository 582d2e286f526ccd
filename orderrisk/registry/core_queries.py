"""Registered queries: feeds, staging, scoring, checks, report, exploration, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.lookups import email_country as email_country_of
from orderrisk.operators import customers, eda, evaluate, quality, report, reshape, rules, scoring, staging
from orderrisk.sources import feeds, files

from . import tables


# --- Sources and sinks ---------------------------------------------------------------------------


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = tables.folder(spark, d, "transactions_csv")
    files.write_csv(feeds.orders(spark, d), path)
    return staging.stage(files.read_orders(spark, path)).withColumns(
        {"order_id": F.col("order_id").cast("bigint"), "customer_id": F.col("customer_id").cast("bigint")}
    )


def _metric_row(spark: SparkSession, d: str) -> DataFrame:
    mart = tables.mart(spark, d).withColumn("share", F.col("risk_score") / F.lit(float(fixed.MAX_SCORE)))
    model = evaluate.baseline_summary(
        evaluate.score_counts(mart, "share", "is_fraud"), fixed.MODEL_FLAG_AT
    )
    baseline = evaluate.baseline_summary(evaluate.score_counts(mart, "risk_score", "is_fraud"))
    names = ["roc_auc", "avg_precision", "fraud_f1"]
    both = model.select(*names, baseline.select(F.struct(*names)).scalar().alias("_b"))
    return both.select(
        *[F.round(name, 4).alias(name) for name in names],
        *[
            F.round(F.col("_b")[name], 4).alias(target)
            for name, target in zip(names, fixed.BASELINE_METRICS, strict=True)
        ],
    )


def metrics_long(spark: SparkSession, d: str) -> DataFrame:
    path = tables.folder(spark, d, "metrics_json")
    files.write_metrics_json(_metric_row(spark, d), path)
    return files.metrics_long(spark, path)


def flagged_export(spark: SparkSession, d: str) -> DataFrame:
    path = tables.folder(spark, d, "flagged_csv")
    files.write_csv(report.sorted_export(flagged_top50(spark, d)), path, quote_all=True)
    return files.read_csv_text(spark, path, fixed.EXPORT_HEADERS)


# --- Card feed -----------------------------------------------------------------------------------


def reshape_card_txns(spark: SparkSession, d: str) -> DataFrame:
    return reshape.reshape_card_txns(feeds.card_txns(spark, d))


def email_country(spark: SparkSession, d: str) -> DataFrame:
    return feeds.card_txns(spark, d).select(
        F.col("TransactionID").alias("order_id"),
        email_country_of("R_emaildomain").alias("shipping_country"),
        email_country_of("P_emaildomain").alias("ip_country"),
    )


def impute_median(spark: SparkSession, d: str) -> DataFrame:
    cards = feeds.card_txns(spark, d)
    return cards.select(
        F.col("TransactionID").alias("order_id"), reshape.impute_median(cards, "D1").alias("account_age_days")
    )


def singleton_card(spark: SparkSession, d: str) -> DataFrame:
    cards = feeds.card_txns(spark, d).select("TransactionID", "card1")
    flagged = reshape.singleton_flag(cards, "card1", "TransactionID", "is_new_customer")
    return flagged.select(F.col("TransactionID").alias("order_id"), "is_new_customer")


def reshape_profile(spark: SparkSession, d: str) -> DataFrame:
    return reshape.reshape_profile(reshape_card_txns(spark, d))


# --- Staging, customers, mart --------------------------------------------------------------------


def stg_transactions(spark: SparkSession, d: str) -> DataFrame:
    return tables.stg(spark, d)


def daily_order_counts(spark: SparkSession, d: str) -> DataFrame:
    return customers.daily_order_counts(tables.stg(spark, d))


def order_velocity(spark: SparkSession, d: str) -> DataFrame:
    return customers.order_velocity(tables.stg(spark, d))


def customer_risk_profile(spark: SparkSession, d: str) -> DataFrame:
    return customers.risk_profile(tables.stg(spark, d))


def fct_fraud_signals(spark: SparkSession, d: str) -> DataFrame:
    return scoring.fct_fraud_signals(tables.stg(spark, d))


def risk_score(spark: SparkSession, d: str) -> DataFrame:
    return fct_fraud_signals(spark, d).select("order_id", "risk_score")


def risk_tier(spark: SparkSession, d: str) -> DataFrame:
    return fct_fraud_signals(spark, d).select("order_id", "fraud_flag", "risk_tier")


def rule_points_long(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_points_long(tables.mart(spark, d), rules.MART_RULES)


def score_variant(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_variant(tables.stress_stg(spark, d))


def rule_coverage(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_coverage(score_variant(spark, d), rules.VARIANT_RULES, fixed.COVERAGE_RULE_LABELS)


def score_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """Every order replays a boundary case; per case, the score and how many orders agree with it."""
    return scoring.boundary_report(feeds.orders(spark, d).select("order_id"))


def rule_attribution(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_attribution(tables.mart(spark, d), rules.MART_RULES)


# --- Quality -------------------------------------------------------------------------------------


def _suite_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "stg_transactions": tables.stg(spark, d),
        "int_customer_order_velocity": order_velocity(spark, d),
        "int_customer_risk_profile": customer_risk_profile(spark, d),
        "fct_fraud_signals": tables.mart(spark, d),
    }


def _suite(test: str | None):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return quality.run_suite(_suite_tables(spark, d), tests={test} if test else None)

    return run


def dq_stress_feed(spark: SparkSession, d: str) -> DataFrame:
    """The staging checks on the stress feed, whose words lie outside the accepted lists."""
    return quality.run_suite({"stg_transactions": tables.stress_stg(spark, d)})


# --- Report --------------------------------------------------------------------------------------


def report_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.summary(tables.mart(spark, d))


def tier_distribution(spark: SparkSession, d: str) -> DataFrame:
    return report.tier_distribution(tables.mart(spark, d))


def rule_hits(spark: SparkSession, d: str) -> DataFrame:
    return report.rule_hits(tables.mart(spark, d))


def rule_hits_scaled(spark: SparkSession, d: str) -> DataFrame:
    return report.rule_hits_scaled(tables.mart(spark, d))


def ml_metric_cards(spark: SparkSession, d: str) -> DataFrame:
    """Cards of the model's metrics; the baseline's are left out and read N/A."""
    metrics = _metric_row(spark, d).select("roc_auc", "avg_precision", "fraud_f1")
    return report.ml_metric_cards(metrics.unpivot([], metrics.columns, "metric", "value"))


def ml_summary(spark: SparkSession, d: str) -> DataFrame:
    mart = tables.mart(spark, d)
    return report.ml_summary(mart, tables.stand_in_predictions(mart))


def flagged_top50(spark: SparkSession, d: str) -> DataFrame:
    mart = tables.mart(spark, d)
    return report.flagged_top(mart, tables.stand_in_predictions(mart))


def flagged_bars(spark: SparkSession, d: str) -> DataFrame:
    return report.flagged_bars(flagged_top50(spark, d))


def flagged_filter(spark: SparkSession, d: str) -> DataFrame:
    return report.flagged_filter(flagged_top50(spark, d), tier="high", payment="visa")


# --- Exploration ---------------------------------------------------------------------------------


def class_balance(spark: SparkSession, d: str) -> DataFrame:
    return eda.class_balance(tables.mart(spark, d))


def amount_histogram(spark: SparkSession, d: str) -> DataFrame:
    return eda.histogram(
        tables.mart(spark, d), "order_amount", fixed.AMOUNT_BINS, clip=fixed.AMOUNT_CLIP
    )


def amount_describe(spark: SparkSession, d: str) -> DataFrame:
    return eda.amount_describe(tables.mart(spark, d))


def fraud_rate_by_category(spark: SparkSession, d: str) -> DataFrame:
    return eda.rate_by(tables.mart(spark, d), "product_category")


def fraud_rate_by_payment(spark: SparkSession, d: str) -> DataFrame:
    return eda.rate_by(tables.mart(spark, d), "payment_method")


def fraud_rate_by_tier(spark: SparkSession, d: str) -> DataFrame:
    return eda.rate_by(tables.mart(spark, d), "risk_tier")


def fraud_rate_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return eda.rate_by_hour(tables.mart(spark, d))


def fraud_rate_by_age(spark: SparkSession, d: str) -> DataFrame:
    return eda.rate_by_age(tables.mart(spark, d))


def rule_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    return eda.rule_quality(tables.mart(spark, d))


def score_density(spark: SparkSession, d: str) -> DataFrame:
    return eda.histogram(tables.mart(spark, d), "risk_score", fixed.SCORE_BINS, density=True)


def correlations(spark: SparkSession, d: str) -> DataFrame:
    return eda.correlations(tables.mart(spark, d))


# --- Evaluation ----------------------------------------------------------------------------------


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.score_counts(tables.mart(spark, d), "risk_score", "is_fraud")


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(tables.mart(spark, d), "fraud_flag", "is_fraud")


def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.classification_report(_cells(spark, d))


def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.threshold_sweep(evaluate.cumulate(_counts(spark, d)))


def best_threshold(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_threshold(threshold_sweep(spark, d))


def roc_curve(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.roc_curve(evaluate.cumulate(_counts(spark, d)))


def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.roc_auc(evaluate.cumulate(_counts(spark, d)))


def pr_curve(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.pr_curve(evaluate.cumulate(_counts(spark, d)))


def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.average_precision(evaluate.cumulate(_counts(spark, d)))


def f1_score(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.hard_label_metrics(_cells(spark, d)).select("fraud_f1")


def baseline_summary(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.baseline_summary(_counts(spark, d))


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "metrics_long": metrics_long,
    "flagged_export": flagged_export,
    "reshape_card_txns": reshape_card_txns,
    "email_country": email_country,
    "impute_median": impute_median,
    "singleton_card": singleton_card,
    "reshape_profile": reshape_profile,
    "stg_transactions": stg_transactions,
    "daily_order_counts": daily_order_counts,
    "order_velocity": order_velocity,
    "customer_risk_profile": customer_risk_profile,
    "fct_fraud_signals": fct_fraud_signals,
    "risk_score": risk_score,
    "risk_tier": risk_tier,
    "rule_points_long": rule_points_long,
    "score_variant": score_variant,
    "rule_coverage": rule_coverage,
    "score_boundaries": score_boundaries,
    "rule_attribution": rule_attribution,
    "dq_not_null": _suite("not_null"),
    "dq_unique": _suite("unique"),
    "dq_accepted_values": _suite("accepted_values"),
    "dq_suite": _suite(None),
    "dq_stress_feed": dq_stress_feed,
    "report_summary": report_summary,
    "tier_distribution": tier_distribution,
    "rule_hits": rule_hits,
    "rule_hits_scaled": rule_hits_scaled,
    "ml_metric_cards": ml_metric_cards,
    "ml_summary": ml_summary,
    "flagged_top50": flagged_top50,
    "flagged_bars": flagged_bars,
    "flagged_filter": flagged_filter,
    "class_balance": class_balance,
    "amount_histogram": amount_histogram,
    "amount_describe": amount_describe,
    "fraud_rate_by_category": fraud_rate_by_category,
    "fraud_rate_by_payment": fraud_rate_by_payment,
    "fraud_rate_by_tier": fraud_rate_by_tier,
    "fraud_rate_by_hour": fraud_rate_by_hour,
    "fraud_rate_by_age": fraud_rate_by_age,
    "rule_precision_recall": rule_precision_recall,
    "score_density": score_density,
    "correlations": correlations,
    "confusion_matrix": _cells,
    "classification_report": classification_report,
    "threshold_sweep": threshold_sweep,
    "best_threshold": best_threshold,
    "roc_curve": roc_curve,
    "roc_auc": roc_auc,
    "pr_curve": pr_curve,
    "average_precision": average_precision,
    "f1_score": f1_score,
    "baseline_summary": baseline_summary,
}

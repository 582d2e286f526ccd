"""The report, exploration and baseline tables of a mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.operators import eda, evaluate, report, rules


def report_tables(
    mart: DataFrame,
    preds: DataFrame | None = None,
    metrics: DataFrame | None = None,
    tier: str | None = None,
    payment: str | None = None,
    category: str | None = None,
) -> dict[str, DataFrame]:
    """All report tables. Without predictions or metrics those parts read N/A, null or 0.

    The export holds those of the top orders that fit the choices, as the filtered table shows them.
    """
    spark = mart.sparkSession
    if metrics is None:
        metrics = spark.createDataFrame([], "metric string, value double")
    known = preds is not None
    if not known:
        key = mart.schema["order_id"].dataType.simpleString()
        preds = spark.createDataFrame(
            [], f"order_id {key}, ml_fraud_prob double, ml_fraud_flag int"
        )
    ml_summary = report.ml_summary(mart, preds)
    if not known:
        ml_summary = ml_summary.withColumn("ml_flagged", F.lit(None).cast("bigint"))
    top = report.flagged_top(mart, preds)
    return {
        "report_summary": report.summary(mart),
        "tier_distribution": report.tier_distribution(mart),
        "rule_hits": report.rule_hits_scaled(mart),
        "ml_metric_cards": report.ml_metric_cards(metrics),
        "ml_summary": ml_summary,
        "flagged_top50": report.flagged_bars(top),
        "flagged_export": report.sorted_export(report.flagged_filter(top, tier, payment, category)),
    }


def exploration_tables(mart: DataFrame) -> dict[str, DataFrame]:
    """The numbers behind every exploratory chart."""
    return {
        "class_balance": eda.class_balance(mart),
        "amount_histogram": eda.histogram(
            mart, "order_amount", fixed.AMOUNT_BINS, clip=fixed.AMOUNT_CLIP
        ),
        "amount_describe": eda.amount_describe(mart),
        "fraud_rate_by_category": eda.rate_by(mart, "product_category"),
        "fraud_rate_by_payment": eda.rate_by(mart, "payment_method"),
        "fraud_rate_by_tier": eda.rate_by(mart, "risk_tier"),
        "fraud_rate_by_hour": eda.rate_by_hour(mart),
        "fraud_rate_by_age": eda.rate_by_age(mart),
        "rule_precision_recall": eda.rule_quality(mart),
        "score_density": eda.histogram(mart, "risk_score", fixed.SCORE_BINS, density=True),
        "correlations": eda.correlations(mart),
    }


def baseline_tables(mart: DataFrame) -> dict[str, DataFrame]:
    """How well the rules find fraud: all from the label counts per score."""
    cells = evaluate.confusion(mart, "fraud_flag", "is_fraud")
    counts = evaluate.score_counts(mart, "risk_score", "is_fraud")
    cum = evaluate.cumulate(counts)
    sweep = evaluate.threshold_sweep(cum)
    return {
        "confusion_matrix": cells,
        "classification_report": evaluate.classification_report(cells),
        "threshold_sweep": sweep,
        "best_threshold": evaluate.best_threshold(sweep),
        "roc_curve": evaluate.roc_curve(cum),
        "pr_curve": evaluate.pr_curve(cum),
        "baseline_summary": evaluate.baseline_summary(counts),
        "rule_attribution": rules.rule_attribution(mart, rules.MART_RULES),
    }

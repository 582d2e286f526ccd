"""A small tree model given by hand, applied to every order: scoring, evaluation, publishing and explanation that SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.hashing import hash60
from orderrisk.operators import explain, features, models
from orderrisk.operators.trees import TreeModel, grown

from . import tables
from .model_oracles import FEATURE_SQL, NAMES, key_hash
from .oracle_base import with_mart

BASE = -0.4


def _tree(*nodes: tuple) -> dict[str, list]:
    """From (input or None, threshold, left, right, value, cover)."""
    columns = list(zip(*nodes, strict=True))
    inputs = [features.FEATURES.index(name) if name else -1 for name in columns[0]]
    return {"input": inputs, "threshold": columns[1], "left": columns[2], "right": columns[3], "value": columns[4], "cover": columns[5], "gain": [0.0] * len(nodes)}


def model() -> TreeModel:
    """Large amounts; a foreign address, more so in the early hours; two countries. All sums of leaves differ, so no scores tie."""
    amount = _tree(("order_amount", 150.0, 1, 2, 0.0, 100.0), (None, 0.0, 1, 1, -0.83, 70.0), (None, 0.0, 2, 2, 0.91, 30.0))
    address = _tree(
        ("ip_mismatch", 0.5, 1, 2, 0.0, 100.0), (None, 0.0, 1, 1, -0.52, 60.0), ("order_hour", 5.5, 3, 4, 0.0, 40.0),
        (None, 0.0, 3, 3, 1.24, 10.0), (None, 0.0, 4, 4, 0.37, 30.0),
    )
    country = _tree(("country_mismatch", 0.5, 1, 2, 0.0, 100.0), (None, 0.0, 1, 1, -0.31, 50.0), (None, 0.0, 2, 2, 0.66, 50.0))
    return grown(features.FEATURES, "logistic", BASE, [amount, address, country])


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return features.feature_matrix(tables.mart(spark, d))


def tree_model_predict(spark: SparkSession, d: str) -> DataFrame:
    return models.predict(model(), tables.mart(spark, d))


def tree_model_metrics(spark: SparkSession, d: str) -> DataFrame:
    found = models.evaluate_model(model(), _rows(spark, d))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


def tree_model_metric_rows(spark: SparkSession, d: str) -> DataFrame:
    return models.metric_rows(models.evaluate_model(model(), _rows(spark, d)))


def _shap(spark: SparkSession, d: str) -> DataFrame:
    return tables.written_once(spark, d, "tree_model_shap", lambda: explain.tree_shap(model(), _rows(spark, d)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in names})


def tree_model_shap(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_shap(spark, d), "contribution", "base_value")


def tree_model_shap_importance(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(explain.shap_importance(_shap(spark, d)), "mean_abs")


def tree_model_shap_dependence(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(explain.shap_dependence(_shap(spark, d), interactions=False), "contribution")


def tree_model_shap_local(spark: SparkSession, d: str) -> DataFrame:
    found = explain.shap_local(_shap(spark, d), models.scored(model(), _rows(spark, d)), hash60(F.col("order_id"), "sample"))
    return _rounded(found, "prob", "base_value", "contribution")


QUERIES = {
    "tree_model_predict": tree_model_predict,
    "tree_model_metrics": tree_model_metrics,
    "tree_model_metric_rows": tree_model_metric_rows,
    "tree_model_shap": tree_model_shap,
    "tree_model_shap_importance": tree_model_shap_importance,
    "tree_model_shap_dependence": tree_model_shap_dependence,
    "tree_model_shap_local": tree_model_shap_local,
}

# What each tree expects when nothing is known, and with one input known, from the covers.
_MEANS = {"amount": "(-0.83 * 70 + 0.91 * 30) / 100", "address": "(-0.52 * 60 + 1.24 * 10 + 0.37 * 30) / 100", "country": "(-0.31 * 50 + 0.66 * 50) / 100"}
_SCORED = f"""
scored as (
  select order_id, is_fraud, 1.0 / (1.0 + exp(-({BASE}
    + case when order_amount <= 150 then -0.83 else 0.91 end
    + case when ip_mismatch <= 0.5 then -0.52 when order_hour <= 5.5 then 1.24 else 0.37 end
    + case when country_mismatch <= 0.5 then -0.31 else 0.66 end))) as prob from inputs)"""
_CURVE = """
levels as (
  select prob, sum(is_fraud) as pos, sum(1 - is_fraud) as neg from scored group by prob),
curve as (
  select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as p, sum(neg) over () as n
  from levels window w as (order by prob desc)),
metrics as (
  select sum(neg * (2 * tp - pos)) / (2.0 * max(p) * max(n)) as roc_auc,
    sum(pos * tp / (tp + fp)) / max(p) as avg_precision,
    2.0 * coalesce(sum(pos) filter (where prob >= 0.5), 0) / nullif(coalesce(sum(pos + neg) filter (where prob >= 0.5), 0) + max(p), 0) as fraud_f1,
    coalesce(sum(pos) filter (where prob >= 0.5) / nullif(sum(pos + neg) filter (where prob >= 0.5), 0), 0) as fraud_precision,
    coalesce(sum(pos) filter (where prob >= 0.5), 0) / max(p) as fraud_recall
  from curve)"""

# Half the gain of an input before and half of its gain after the other one of its tree.
_HOUR = "case when order_hour <= 5.5 then 1.24 else 0.37 end"
_ADDRESS = f"case when ip_mismatch <= 0.5 then -0.52 else {_HOUR} end"
_ADDRESS_KNOWN = "case when ip_mismatch <= 0.5 then -0.52 else (1.24 * 10 + 0.37 * 30) / 40 end"
_HOUR_KNOWN = f"(-0.52 * 60 + 40 * ({_HOUR})) / 100"
_PARTS = {
    "order_amount": f"case when order_amount <= 150 then -0.83 else 0.91 end - ({_MEANS['amount']})",
    "country_mismatch": f"case when country_mismatch <= 0.5 then -0.31 else 0.66 end - ({_MEANS['country']})",
    "ip_mismatch": f"(({_ADDRESS_KNOWN}) - ({_MEANS['address']}) + ({_ADDRESS}) - ({_HOUR_KNOWN})) / 2",
    "order_hour": f"(({_HOUR_KNOWN}) - ({_MEANS['address']}) + ({_ADDRESS}) - ({_ADDRESS_KNOWN})) / 2",
}
_BASE_VALUE = f"cast({BASE} + {' + '.join(f'({m})' for m in _MEANS.values())} as double)"
_SHAP = "\nshap as (" + " union all ".join(
    f"""select order_id, '{name}' as feature, "{name}" as value, cast({_PARTS.get(name, "0")} as double) as contribution, {_BASE_VALUE} as base_value from inputs"""
    for name in NAMES
) + ")"
_RANKS = """
means as (select feature, avg(abs(contribution)) as mean_abs from shap group by 1),
ranks as (
  select feature, mean_abs, cast(row_number() over (order by mean_abs desc, feature) as int) as rank,
    mean_abs >= (select quantile_cont(mean_abs, 0.75) from means) as highlight from means)"""
_LOCAL = f"""
firsts as (
  select case when prob >= 0.5 then 'true_positive' else 'false_negative' end as "case", order_id, prob from scored where is_fraud = 1
  qualify row_number() over (partition by prob >= 0.5 order by {key_hash("sample")}, order_id) = 1),
lines as (
  select "case", s.order_id, prob, base_value, feature, value, contribution,
    row_number() over (partition by "case" order by abs(contribution) desc, feature) as place
  from shap s join firsts f on s.order_id = f.order_id)"""

ORACLES = {
    "tree_model_predict": with_mart(FEATURE_SQL, _SCORED)
    + " select order_id, round_even(prob * 10000, 0) / 10000 as ml_fraud_prob, cast(prob >= 0.5 as int) as ml_fraud_flag from scored",
    "tree_model_metrics": with_mart(FEATURE_SQL, _SCORED, _CURVE)
    + f" select {', '.join(f'round(cast({m} as double), 9) as {m}' for m in ('roc_auc', 'avg_precision', 'fraud_f1', 'fraud_precision', 'fraud_recall'))} from metrics",
    "tree_model_metric_rows": with_mart(FEATURE_SQL, _SCORED, _CURVE)
    + " union all ".join(
        [f" select '{m}' as metric, round(cast({m} as double), 4) as value from metrics" for m in ("roc_auc", "avg_precision", "fraud_f1")]
        + [f" select '{m}', cast({v} as double)" for m, v in fixed.BASELINE_METRICS.items()]
    ),
    "tree_model_shap": with_mart(FEATURE_SQL, _SHAP)
    + " select order_id, feature, value, round(contribution, 9) as contribution, round(base_value, 9) as base_value from shap",
    "tree_model_shap_importance": with_mart(FEATURE_SQL, _SHAP, _RANKS)
    + " select feature, round(mean_abs, 9) as mean_abs, rank, rank <= 5 as top5, highlight from ranks",
    "tree_model_shap_dependence": with_mart(FEATURE_SQL, _SHAP, _RANKS)
    + " select feature, order_id, value, round(contribution, 9) as contribution, rank from shap join ranks using (feature) where rank <= 3",
    "tree_model_shap_local": with_mart(FEATURE_SQL, _SCORED, _SHAP, _LOCAL)
    + """ select "case", order_id, round(prob, 9) as prob, round(base_value, 9) as base_value, cast(least(place, 10) as int) as place,
        case when place > 9 then '8 other features' else feature end as feature, max(case when place <= 9 then value end) as value,
        round(sum(contribution), 9) as contribution
      from lines group by all""",
}

"""Train on the mart, publish predictions and metrics, and explain the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.hashing import hash60
from orderrisk.operators import explain, features, models, sampling
from orderrisk.operators.trees import TreeModel
from orderrisk.sources import files


def split_rows(mart: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. The split is written once, since a fit reads it many times."""
    rows = files.write_table(sampling.stratified_split(features.feature_matrix(mart)), path)
    return rows.where(~F.col("is_test")).drop("is_test"), rows.where("is_test").drop("is_test")


def train(mart: DataFrame, out: str, iters: int = 200) -> dict[str, DataFrame]:
    """Fits the boosted model and writes model, metrics.json, ml_predictions and ml_metrics."""
    train_rows, test_rows = split_rows(mart, f"{out}/model_rows")
    model = models.fit_gbt(train_rows, iters=iters)
    models.save_model(model, f"{out}/model")
    metrics = models.metric_rows(models.evaluate_model(model, test_rows))
    wide = metrics.groupBy().pivot("metric", fixed.METRIC_NAMES).agg(F.first("value"))
    files.write_metrics_json(wide, f"{out}/metrics.json")
    return {
        "ml_predictions": files.write_table(models.predict(model, mart), f"{out}/ml_predictions"),
        "ml_metrics": files.write_table(metrics, f"{out}/ml_metrics"),
    }


def predict(mart: DataFrame, out: str) -> dict[str, DataFrame]:
    """Scores every order with the saved model and republishes its stored metrics."""
    model = models.load_model(f"{out}/model")
    if not files.exists(mart.sparkSession, f"{out}/metrics.json"):
        raise FileNotFoundError(f"{out}/metrics.json not found: train a model first")
    metrics = files.metrics_long(mart.sparkSession, f"{out}/metrics.json")
    return {
        "ml_predictions": files.write_table(models.predict(model, mart), f"{out}/ml_predictions"),
        "ml_metrics": files.write_table(metrics, f"{out}/ml_metrics"),
    }


def compare(mart: DataFrame, out: str, iters: int = 200, trees: int = 200) -> dict[str, DataFrame]:
    """Ways to treat the imbalance, and candidate models, side by side, each with its report and curves.

    Importances are those of the best candidate.
    """
    train_rows, test_rows = split_rows(mart, f"{out}/model_rows")
    strategies, strategy_counts = models.compare_strategies(train_rows, test_rows)
    compared, counts, fitted = models.compare_models(
        train_rows, test_rows, iters, trees, rule_scores=mart.select("order_id", "risk_score")
    )
    names = [r["model"] for r in compared.collect()]
    best = next(name for name in names if name in fitted)
    return {
        "imbalance_comparison": strategies,
        "model_comparison": compared,
        "winner_importance": models.feature_importance(fitted[best]).select(F.lit(best).alias("model"), "*"),
        **{f"imbalance_{kind}": table for kind, table in models.reports_of(strategy_counts).items()},
        **{f"model_{kind}": table for kind, table in models.reports_of(counts).items()},
    }


def explain_model(
    model: TreeModel, test_rows: DataFrame, out: str, sample: int | None = None
) -> dict[str, DataFrame]:
    """Contributions on all test rows, or on a sample if one is asked for, and the tables drawn from them."""
    rows = test_rows if sample is None else sampling.hash_sample(test_rows, sample)
    shap = files.write_table(explain.tree_shap(model, rows), f"{out}/tree_shap")
    order = hash60(F.col("order_id"), "sample")
    return {
        "tree_shap": shap,
        "shap_importance": explain.shap_importance(shap),
        "shap_dependence": explain.shap_dependence(shap),
        "shap_local": explain.shap_local(shap, models.scored(model, rows), order),
    }

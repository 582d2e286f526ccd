"""Registered queries: model inputs, samples, training, scoring and explanation.

Training queries take every row of the mart and the library's numbers of trees and iterations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.functions.hashing import hash60
from orderrisk.operators import explain, features, models, sampling
from orderrisk.operators.trees import TreeModel

from . import tables


def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    return features.feature_matrix(tables.mart(spark, d))


def _split(spark: SparkSession, d: str) -> DataFrame:
    """The feature matrix with its split, written once: every fit and evaluation reads it."""
    return tables.written_once(
        spark, d, "model_rows", lambda: sampling.stratified_split(feature_matrix(spark, d))
    )


def _train(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).where(~F.col("is_test")).drop("is_test")


def _test(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).where(F.col("is_test")).drop("is_test")


def _fitted(spark: SparkSession, d: str, name: str, fit: Callable[[DataFrame], TreeModel]) -> TreeModel:
    """A model, fitted once per application, saved and loaded back."""
    path = tables.folder(spark, d, name)
    if path not in tables._written:
        models.save_model(fit(_train(spark, d)), path)
        tables._written.add(path)
    return models.load_model(path)


def _model(spark: SparkSession, d: str) -> TreeModel:
    return _fitted(spark, d, "boosted_model", models.fit_gbt)


def _forest(spark: SparkSession, d: str) -> TreeModel:
    return _fitted(spark, d, "forest_model", models.fit_forest)


def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    labelled = tables.mart(spark, d).select("order_id", "is_fraud")
    return sampling.stratified_split(labelled)


def standard_scale(spark: SparkSession, d: str) -> DataFrame:
    scaled = features.fit_scaler(_train(spark, d)).transform(_split(spark, d))
    return scaled.select(
        "order_id", "is_test", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in features.FEATURES]
    )


def class_weights(spark: SparkSession, d: str) -> DataFrame:
    return features.class_weights(_train(spark, d))


def undersample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.undersample(_train(spark, d).select("order_id", "is_fraud"))


def smote_oversample(spark: SparkSession, d: str) -> DataFrame:
    train = _train(spark, d)
    made = sampling.smote(features.fit_scaler(train).transform(train), features.FEATURES)
    return made.select(
        "order_id", "copy", "is_fraud", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in features.FEATURES]
    )


def train_logistic(spark: SparkSession, d: str) -> DataFrame:
    """Coefficients of the balanced logistic regression on scaled inputs."""
    train = _train(spark, d)
    last = models.fit_logistic(features.fit_scaler(train).transform(train), balanced=True).stages[-1]
    rows = list(zip(features.FEATURES, last.coefficients.toArray().tolist(), strict=True))
    return spark.createDataFrame([("(intercept)", last.intercept), *rows], "feature string, coefficient double")


def train_forest(spark: SparkSession, d: str) -> DataFrame:
    return models.evaluate_model(_forest(spark, d), _test(spark, d))


def train_gbt(spark: SparkSession, d: str) -> DataFrame:
    return models.evaluate_model(_model(spark, d), _test(spark, d))


def evaluate_model(spark: SparkSession, d: str) -> DataFrame:
    return models.evaluate_model(_model(spark, d), _test(spark, d))


def imbalance_comparison(spark: SparkSession, d: str) -> DataFrame:
    return models.imbalance_comparison(_train(spark, d), _test(spark, d))


def model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """All candidates; those that other queries use as well are loaded if they are there, and saved if not."""
    paths = {models.FOREST: tables.folder(spark, d, "forest_model"), models.BOOSTED: tables.folder(spark, d, "boosted_model")}
    known = {name: models.load_model(path) for name, path in paths.items() if path in tables._written}
    table, _, fitted = models.compare_models(_train(spark, d), _test(spark, d), fitted=known)
    for name in paths.keys() - known.keys():
        models.save_model(fitted[name], paths[name])
        tables._written.add(paths[name])
    return table


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    return models.feature_importance(_model(spark, d))


def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    return models.permutation_importance(_model(spark, d), _test(spark, d))


def batch_predict(spark: SparkSession, d: str) -> DataFrame:
    return models.predict(_model(spark, d), tables.mart(spark, d))


def write_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = models.metric_rows(evaluate_model(spark, d))
    return tables.files.write_table(rows, tables.folder(spark, d, "ml_metrics"))


def shap_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.hash_sample(_test(spark, d)).select("order_id", "is_fraud")


def tree_shap(spark: SparkSession, d: str) -> DataFrame:
    """All test rows, written once: the tables below are drawn from it."""
    made = lambda: explain.tree_shap(_model(spark, d), _test(spark, d))
    return tables.written_once(spark, d, "tree_shap", made)


def shap_importance(spark: SparkSession, d: str) -> DataFrame:
    return explain.shap_importance(tree_shap(spark, d))


def shap_dependence(spark: SparkSession, d: str) -> DataFrame:
    return explain.shap_dependence(tree_shap(spark, d))


def shap_beeswarm(spark: SparkSession, d: str) -> DataFrame:
    return explain.shap_dependence(tree_shap(spark, d), top=None, interactions=False)


def shap_local(spark: SparkSession, d: str) -> DataFrame:
    rows = models.scored(_model(spark, d), _test(spark, d))
    return explain.shap_local(tree_shap(spark, d), rows, hash60(F.col("order_id"), "sample"))


QUERIES = {
    "feature_matrix": feature_matrix,
    "stratified_split": stratified_split,
    "standard_scale": standard_scale,
    "class_weights": class_weights,
    "undersample": undersample,
    "smote_oversample": smote_oversample,
    "train_logistic": train_logistic,
    "train_forest": train_forest,
    "train_gbt": train_gbt,
    "evaluate_model": evaluate_model,
    "imbalance_comparison": imbalance_comparison,
    "model_comparison": model_comparison,
    "feature_importance": feature_importance,
    "permutation_importance": permutation_importance,
    "batch_predict": batch_predict,
    "write_metrics": write_metrics,
    "tree_shap": tree_shap,
    "shap_sample": shap_sample,
    "shap_importance": shap_importance,
    "shap_dependence": shap_dependence,
    "shap_beeswarm": shap_beeswarm,
    "shap_local": shap_local,
}

"""Distributed classifiers under class imbalance: fit, evaluate, compare, score, rank inputs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.session import cut_lineage
from orderrisk.sources.files import exists

from . import boosting, evaluate, forest, permuting, trees
from .features import FEATURES, assembler, class_weights, feature_matrix, fit_scaler, with_weight
from .sampling import smote, undersample
from .trees import TreeModel

LABEL = "is_fraud"
LINEAR = "Logistic Regression"
FOREST = "Random Forest"
BOOSTED = "Boosted trees, weighted, step 0.3"
RULES_HERE = "Rule score, same test rows"
# Rows of a partition of a linear fit. Gradients are summed over all partitions, so their number changes nothing else.
FIT_ROWS = 1 << 15
_METRICS = ["roc_auc", "avg_precision", "fraud_f1", "fraud_precision", "fraud_recall"]


def _fit(estimator, train: DataFrame) -> PipelineModel:
    """Fits the inputs' assembler and the estimator on rows dealt by their key, in order of it.

    The estimator caches its own compact form of the rows, so the training rows should come from a written table and
    are not cached a second time. Partitions follow the number of rows.
    """
    pieces = max(1, -(-train.count() // FIT_ROWS))
    dealt = train.repartition(pieces, "order_id").sortWithinPartitions("order_id")
    return Pipeline(stages=[assembler(), estimator]).fit(dealt)


def fit_logistic(
    train: DataFrame, balanced: bool = False, max_iter: int = 1000, c: float = 1.0
) -> PipelineModel:
    """Logistic regression on scaled inputs with an L2 penalty of 1/c on the summed loss."""
    rows, weight_column = train, None
    total = F.count(F.lit(1)).cast("double")
    if balanced:
        rows, weight_column = with_weight(train, "balanced_weight"), "weight"
        total = F.sum("weight")
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=max_iter,
        regParam=1.0 / (c * rows.agg(total).first()[0]),
        standardization=False,
        tol=1e-6,
    )
    if weight_column:
        estimator = estimator.setWeightCol(weight_column)
    return _fit(estimator, rows)


def fit_forest(train: DataFrame, count: int = 200, depth: int = 12) -> TreeModel:
    """Random forest with balanced class weights."""
    return forest.fit(train, FEATURES, _weights(train, "balanced_weight"), count, depth)


def _weights(train: DataFrame, kind: str) -> tuple[float, float]:
    """The weight of each class; 1 for a class without rows."""
    found = {r[LABEL]: r[kind] for r in class_weights(train).collect()}
    return tuple(float(found.get(c) or 1.0) for c in (0, 1))


def fit_gbt(
    train: DataFrame,
    weights: str = "boost_weight",
    iters: int = 200,
    depth: int = 6,
    step: float = 0.3,
    l2: float = 1.0,
    min_curvature: float = 1.0,
    min_rows: int = 1,
) -> TreeModel:
    """Boosted trees of the second order; ``weights`` names the class weighting."""
    return boosting.fit(train, FEATURES, _weights(train, weights), iters, depth, step, l2, min_curvature, min_rows)


def probability_of(model: TreeModel | PipelineModel) -> Callable[[np.ndarray], np.ndarray]:
    """The model as a function from a matrix of inputs to probabilities; a linear one takes scaled inputs."""
    if isinstance(model, TreeModel):
        return model.probability
    last = model.stages[-1]
    weights, shift = last.coefficients.toArray(), last.intercept
    return lambda x: 1.0 / (1.0 + np.exp(-(x @ weights + shift)))


def scored(model: TreeModel | PipelineModel, rows: DataFrame) -> DataFrame:
    """Key, label (if the rows have one), raw probability and hard label at 0.5."""
    label = [LABEL for c in rows.columns if c == LABEL]
    if isinstance(model, TreeModel):
        found = model.scored(rows, "order_id", *label)
    else:
        found = model.transform(rows).select("order_id", *label, vector_to_array("probability")[1].alias("prob"))
    return found.withColumn("pred", F.when(F.col("prob") >= fixed.MODEL_FLAG_AT, 1).otherwise(0))


def evaluate_model(model: TreeModel | PipelineModel, test: DataFrame) -> DataFrame:
    """AUC, average precision, F1, precision and recall on the test rows: one row."""
    return _metrics_of(label_counts(model, test))


def label_counts(model: TreeModel | PipelineModel, test: DataFrame) -> DataFrame:
    """Counts of both labels per distinct probability, written: every metric and curve follows from them."""
    return cut_lineage(evaluate.score_counts(scored(model, test), "prob", LABEL))


def _metrics_of(counts: DataFrame) -> DataFrame:
    ranked = evaluate.ranking_metrics(evaluate.ranked(counts)).first()
    hard = evaluate.hard_label_metrics(evaluate.confusion_at(counts, fixed.MODEL_FLAG_AT)).first()
    values = {**ranked.asDict(), **hard.asDict()}
    schema = ", ".join(f"{name} double" for name in _METRICS)
    return counts.sparkSession.createDataFrame([tuple(values[name] for name in _METRICS)], schema)


def model_report(counts: DataFrame) -> dict[str, DataFrame]:
    """What a score says about its test rows, from its label counts: confusion, report per class, both curves."""
    cells = evaluate.confusion_at(counts, fixed.MODEL_FLAG_AT)
    ranked = cut_lineage(evaluate.ranked(counts))
    return {
        "confusion_matrix": cells,
        "classification_report": evaluate.classification_report(cells),
        "roc_curve": evaluate.roc_curve(ranked),
        "pr_curve": evaluate.pr_curve(ranked),
    }


def reports_of(counts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The reports of several scores as one table of each kind, named by ``model``."""
    made = [(name, model_report(held)) for name, held in counts.items()]
    out = {}
    for kind in made[0][1]:
        parts = [tables[kind].select(F.lit(name).alias("model"), "*") for name, tables in made]
        out[kind] = reduce(DataFrame.unionByName, parts)
    return out


def _metric_table(spark: SparkSession, rows: list[tuple], name: str, metrics: list[str]) -> DataFrame:
    """One row per fitted model, at three decimals (a handful of rows)."""
    schema = f"{name} string, " + ", ".join(f"{m} double" for m in metrics)
    table = spark.createDataFrame(rows, schema)
    return table.select(name, *[F.round(m, 3).alias(m) for m in metrics])


def imbalance_comparison(train: DataFrame, test: DataFrame, max_iter: int = 1000) -> DataFrame:
    """Four ways to treat the imbalance, with logistic regression as the probe.

    ``best_for`` lists the metrics in which the strategy is the (first) best.
    """
    return compare_strategies(train, test, max_iter)[0]


def compare_strategies(train: DataFrame, test: DataFrame, max_iter: int = 1000) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The comparison, and each strategy's label counts for its report."""
    scaler = fit_scaler(train)
    train, test = scaler.transform(train), scaler.transform(test)
    strategies: list[tuple[str, Callable[[], PipelineModel]]] = [
        ("No handling", lambda: fit_logistic(train, max_iter=max_iter)),
        ("Class weights (balanced)", lambda: fit_logistic(train, balanced=True, max_iter=max_iter)),
        (
            "Random undersampling",
            lambda: fit_logistic(cut_lineage(undersample(train)), max_iter=max_iter),
        ),
        ("SMOTE", lambda: fit_logistic(cut_lineage(smote(train, FEATURES)), max_iter=max_iter)),
    ]
    counts = {name: label_counts(fit(), test) for name, fit in strategies}
    rows = [(name, *_metrics_of(held).first()) for name, held in counts.items()]
    table = _metric_table(train.sparkSession, rows, "strategy", _METRICS)
    order = F.create_map(*[F.lit(v) for i, (name, _) in enumerate(strategies) for v in (name, i)])
    ranked = table.withColumn("_order", order[F.col("strategy")])
    first = [
        F.when(
            F.row_number().over(Window.orderBy(F.col(m).desc(), "_order")) == 1, F.lit(m)
        )
        for m in _METRICS
    ]
    return ranked.withColumn("best_for", F.concat_ws(",", *first)).drop("_order"), counts


def model_fits(iters: int = 200, trees: int = 200, max_iter: int = 1000) -> dict[str, Callable]:
    """The four candidates; the linear one needs scaled inputs."""
    return {
        LINEAR: lambda rows: fit_logistic(rows, balanced=True, max_iter=max_iter),
        FOREST: lambda rows: fit_forest(rows, trees),
        "Boosted trees, balanced, step 0.1": lambda rows: fit_gbt(
            rows, "balanced_weight", iters=iters, step=0.1, l2=0.0, min_curvature=1e-3, min_rows=20
        ),
        BOOSTED: lambda rows: fit_gbt(rows, "boost_weight", iters=iters, step=0.3),
    }


def model_comparison(
    train: DataFrame,
    test: DataFrame,
    iters: int = 200,
    trees: int = 200,
    max_iter: int = 1000,
    fitted: dict[str, TreeModel | PipelineModel] | None = None,
) -> DataFrame:
    """AUC, average precision and F1 of the candidates and the rule baseline, best AUC first.

    Candidates that are in ``fitted`` are not fitted again.
    """
    return compare_models(train, test, iters, trees, max_iter, fitted)[0]


def compare_models(
    train: DataFrame,
    test: DataFrame,
    iters: int = 200,
    trees: int = 200,
    max_iter: int = 1000,
    fitted: dict[str, TreeModel | PipelineModel] | None = None,
    rule_scores: DataFrame | None = None,
) -> tuple[DataFrame, dict[str, DataFrame], dict[str, TreeModel | PipelineModel]]:
    """The comparison, each candidate's label counts, and the models.

    ``rule_scores`` (order_id, risk_score) adds the rule score on the same test rows beside the published baseline.
    """
    fitted = dict(fitted or {})
    metrics = _METRICS[:3]
    scaler = fit_scaler(train)
    fits = model_fits(iters, trees, max_iter)

    def candidate(name: str) -> DataFrame:
        linear = name == LINEAR
        if name not in fitted:
            fitted[name] = fits[name](scaler.transform(train) if linear else train)
        return label_counts(fitted[name], scaler.transform(test) if linear else test)

    # A forest keeps all cores busy. The other fits are many short passes with pauses between them, so they run side by side.
    found = {FOREST: candidate(FOREST)}
    others = [name for name in fits if name != FOREST]
    with ThreadPoolExecutor(len(others)) as pool:
        running = {name: pool.submit(inheritable_thread_target(train.sparkSession)(candidate), name) for name in others}
        found |= {name: held.result() for name, held in running.items()}
    counts = {name: found[name] for name in fits}
    rows = [(name, *_metrics_of(held).select(metrics).first()) for name, held in counts.items()]
    rows.append((fixed.BASELINE_LABEL, *fixed.BASELINE_METRICS.values()))
    if rule_scores is not None:
        joined = test.select("order_id", LABEL).join(rule_scores, "order_id")
        found = evaluate.baseline_summary(cut_lineage(evaluate.score_counts(joined, "risk_score", LABEL))).first()
        rows.append((RULES_HERE, *[found[m] for m in metrics]))
    table = _metric_table(train.sparkSession, rows, "model", metrics)
    winner = F.row_number().over(Window.orderBy(F.col("roc_auc").desc(), "model")) == 1
    return table.withColumn("winner", winner).orderBy(F.col("roc_auc").desc(), "model"), counts, fitted


def feature_importance(model: TreeModel | PipelineModel, top: int = 12) -> DataFrame:
    """The inputs with the largest importance: share of the gain of a tree model, else absolute coefficients."""
    if isinstance(model, TreeModel):
        values = model.importance().tolist()
    else:
        values = [abs(v) for v in model.stages[-1].coefficients.toArray().tolist()]
    table = SparkSession.active().createDataFrame(list(zip(FEATURES, values, strict=True)), "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature").limit(top)


def permutation_importance(model: TreeModel | PipelineModel, test: DataFrame, repeats: int = fixed.PERMUTATION_REPEATS) -> DataFrame:
    """Mean loss of accuracy when one input is permuted, per input."""
    replaced = model.replaced if isinstance(model, TreeModel) else None
    return permuting.accuracy_drops(test, FEATURES, probability_of(model), repeats, fixed.MODEL_FLAG_AT, LABEL, replaced)


def predict(model: TreeModel | PipelineModel, mart: DataFrame) -> DataFrame:
    """Probability at four decimals and flag (from the unrounded probability) for every order."""
    rows = scored(model, feature_matrix(mart))
    return rows.select(
        "order_id",
        (F.rint(F.col("prob") * 10_000) / 10_000).alias("ml_fraud_prob"),
        F.col("pred").alias("ml_fraud_flag"),
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """Six (metric, value) rows at four decimals: the model's three and the published baseline."""
    flat = metrics.select(
        *[F.round(name, 4).alias(name) for name in _METRICS[:3]],
        *[F.lit(value).alias(name) for name, value in fixed.BASELINE_METRICS.items()],
    )
    return flat.unpivot([], fixed.METRIC_NAMES, "metric", "value")


def save_model(model: TreeModel | PipelineModel, path: str) -> None:
    """Trees as one table row below the path, a linear model as a saved pipeline."""
    if isinstance(model, TreeModel):
        trees.save(model, f"{path}/trees")
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> TreeModel | PipelineModel:
    """The saved model; says what to do when there is none."""
    spark = SparkSession.active()
    if exists(spark, f"{path}/trees"):
        return trees.load(f"{path}/trees")
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} not found: train a model first")
    return PipelineModel.load(path)

"""Curves and metrics against direct computation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderrisk.operators import evaluate, models
from orderrisk.registry import tables


def frame(spark, scores, labels):
    return spark.createDataFrame(list(zip(scores, labels, strict=True)), "s double, y int")


def brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(scores, labels):
    total, last, ap = sum(labels), 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        hit = [y for s, y in zip(scores, labels) if s >= t]
        recall = sum(hit) / total
        ap += (recall - last) * sum(hit) / len(hit)
        last = recall
    return ap


def sample(n, ties, seed):
    rng = np.random.default_rng(seed)
    labels = (rng.random(n) < 0.3).astype(int)
    scores = rng.random(n) + 0.3 * labels
    return (np.round(scores, 1) if ties else scores).tolist(), labels.tolist()


@pytest.mark.parametrize("ties", [True, False])
def test_auc_and_average_precision(spark, ties):
    scores, labels = sample(300, ties, 7)
    counts = evaluate.score_counts(frame(spark, scores, labels), "s", "y")
    got = evaluate.ranking_metrics(evaluate.cumulate(counts)).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(scores, labels), abs=1e-12)
    assert got["avg_precision"] == pytest.approx(brute_ap(scores, labels), abs=1e-9)


def test_ranges_give_the_same_counts_and_curve_as_one_window(spark):
    scores, labels = sample(2000, False, 3)
    counts = evaluate.score_counts(frame(spark, scores, labels), "s", "y").persist()
    cum, ranked = evaluate.cumulate(counts), evaluate.ranked(counts, range_rows=100)
    assert sorted(map(tuple, ranked.drop("inside").collect())) == sorted(map(tuple, cum.collect()))
    want = sorted(map(tuple, evaluate.roc_curve(cum).collect()))
    assert sorted(map(tuple, evaluate.roc_curve(ranked).collect())) == want and len(want) < 2000
    # No window over everything but that over one row a range.
    plan = evaluate.roc_curve(ranked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") <= 3 and "threshold" not in "".join(x for x in plan.splitlines() if "SinglePartition" in x)


def test_ranked_counts_of_no_rows_and_one_score(spark):
    none = evaluate.score_counts(frame(spark, [1.0], [1]), "s", "y")
    assert [tuple(r) for r in evaluate.ranked(none).collect()] == [(1.0, 1, 0, 1, 0, 1, 0, False)]
    assert evaluate.ranked(none.where("false")).count() == 0


def test_auc_does_not_change_under_a_monotone_map(spark, small_dir):
    mart = tables.mart(spark, small_dir).withColumn("t", F.exp(F.col("risk_score") / 100))
    auc = [
        evaluate.roc_auc(evaluate.cumulate(evaluate.score_counts(mart, c, "is_fraud"))).first()[0]
        for c in ("risk_score", "t")
    ]
    assert auc[0] == auc[1]


def test_one_class_only(spark):
    cum = evaluate.cumulate(evaluate.score_counts(frame(spark, [1.0, 2.0], [0, 0]), "s", "y"))
    assert evaluate.roc_auc(cum).first()[0] is None
    assert [r["f1"] for r in evaluate.threshold_sweep(cum).collect()] == [0.0, 0.0]
    assert {r["recall"] for r in evaluate.pr_curve(cum).collect()} == {0.0, 1.0}


def test_roc_keeps_ends_and_drops_straight_stretches(spark):
    scores, labels = [4.0, 4.0, 3.0, 3.0, 2.0, 2.0, 1.0], [1, 0, 1, 0, 1, 0, 0]
    cum = evaluate.cumulate(evaluate.score_counts(frame(spark, scores, labels), "s", "y"))
    kept = sorted(r["threshold"] for r in evaluate.roc_curve(cum).collect())
    assert kept == [1.0, 2.0, 4.0, float("inf")]
    assert evaluate.roc_curve(cum, drop_intermediate=False).count() == 5


def test_pr_curve_ends_at_precision_one(spark):
    cum = evaluate.cumulate(evaluate.score_counts(frame(spark, [2.0, 1.0], [1, 0]), "s", "y"))
    rows = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(cum).collect()}
    assert rows == {2.0: (1.0, 1.0), 1.0: (0.5, 1.0), None: (1.0, 0.0)}


def test_best_threshold_takes_the_lowest_on_ties_and_misses_quietly(spark):
    cum = evaluate.cumulate(evaluate.score_counts(frame(spark, [10.0, 20.0], [0, 0]), "s", "y"))
    rows = {r["choice"]: r["threshold"] for r in evaluate.best_threshold(evaluate.threshold_sweep(cum)).collect()}
    assert rows == {"best": 10.0, "current": None}


def test_classification_report_without_positives_flagged(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "y int, p int")
    rows = {r["class"]: r for r in evaluate.classification_report(evaluate.confusion(df, "p", "y")).collect()}
    assert rows["Fraud"]["precision"] == 0.0 and rows["Fraud"]["support"] == 1
    assert rows["accuracy"]["f1"] == pytest.approx(2 / 3)
    assert rows["weighted avg"]["recall"] == pytest.approx(2 / 3)


def test_confusion_from_counts(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    counts = evaluate.score_counts(mart, "risk_score", "is_fraud")
    want = evaluate.confusion(mart, "fraud_flag", "is_fraud").first()
    assert evaluate.confusion_at(counts, 50).first() == want


def test_reports_of_several_scores(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    share = mart.withColumn("prob", F.col("risk_score") / 165)
    counts = {name: evaluate.score_counts(df, "prob", "is_fraud") for name, df in (("all", share), ("few", share.where("order_id < 500")))}
    found = models.reports_of(counts)
    assert sorted(found) == ["classification_report", "confusion_matrix", "pr_curve", "roc_curve"]
    cells = {r["model"]: r for r in found["confusion_matrix"].collect()}
    want = evaluate.confusion(share.withColumn("p", (F.col("prob") >= 0.5).cast("int")), "p", "is_fraud").first()
    assert tuple(cells["all"])[1:] == tuple(want)
    assert found["classification_report"].where("class = 'Fraud'").count() == 2
    cum = evaluate.cumulate(counts["all"])
    assert sorted(map(tuple, found["roc_curve"].where("model = 'all'").drop("model").collect())) == sorted(map(tuple, evaluate.roc_curve(cum).collect()))

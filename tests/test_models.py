"""Fits, scoring, permutation and explanations."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderrisk.functions.hashing import hash60
from orderrisk.operators import boosting, explain, features, models, permuting, sampling
from orderrisk.operators.features import FEATURES
from orderrisk.plans import modelling
from orderrisk.registry import model_queries, tables


@pytest.fixture(scope="module")
def rows(spark, small_dir):
    return sampling.stratified_split(features.feature_matrix(tables.mart(spark, small_dir))).persist()


@pytest.fixture(scope="module")
def train(rows):
    return rows.where(~F.col("is_test")).drop("is_test")


@pytest.fixture(scope="module")
def test_rows(rows):
    return rows.where("is_test").drop("is_test")


@pytest.fixture(scope="module")
def boosted(train):
    return models.fit_gbt(train, iters=5, depth=4)


def test_features_are_seventeen_in_order(train):
    assert train.columns == ["order_id", "is_fraud", *FEATURES]
    assert FEATURES[-7:] == [
        "payment_method_discover",
        "payment_method_mastercard",
        "payment_method_visa",
        "product_category_Electronics",
        "product_category_Home & Garden",
        "product_category_Services",
        "product_category_Travel",
    ]


def test_a_batch_without_a_word_keeps_its_columns(spark, small_dir):
    part = tables.mart(spark, small_dir).where("payment_method = 'visa'")
    assert features.feature_matrix(part).columns == ["order_id", "is_fraud", *FEATURES]


def test_scaler_is_fitted_on_training_rows(train, test_rows):
    scaler = features.fit_scaler(train)
    scaled = scaler.transform(train).toPandas()[FEATURES]
    assert np.allclose(scaled.mean(), 0, atol=1e-9) and np.allclose(scaled.std(ddof=0), 1, atol=1e-9)
    assert abs(scaler.transform(test_rows).toPandas()["order_amount"].mean()) > 1e-6


def newton(x, y, w, c=1.0, steps=50):
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta, penalty = np.zeros(x1.shape[1]), np.r_[np.full(x.shape[1], 1.0 / c), 0.0]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ beta))
        grad = x1.T @ (w * (p - y)) + penalty * beta
        beta -= np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty), grad)
    return beta


@pytest.mark.parametrize("balanced", [False, True])
def test_logistic_regression_solves_the_penalised_problem(train, balanced):
    scaled = features.fit_scaler(train).transform(train)
    last = models.fit_logistic(scaled, balanced=balanced).stages[-1]
    pdf = scaled.toPandas()
    y = pdf["is_fraud"].to_numpy()
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if balanced else np.ones(len(y))
    want = newton(pdf[FEATURES].to_numpy(), y, w)
    assert np.allclose([*last.coefficients.toArray(), last.intercept], want, atol=2e-3)


def test_predictions_cover_every_order_and_flag_before_rounding(spark, small_dir, boosted):
    mart = tables.mart(spark, small_dir)
    preds = models.predict(boosted, mart)
    raw = models.scored(boosted, features.feature_matrix(mart))
    joined = preds.join(raw, "order_id").collect()
    assert len(joined) == 1000
    for r in joined:
        assert r["ml_fraud_flag"] == int(r["prob"] >= 0.5)
        assert abs(r["ml_fraud_prob"] - r["prob"]) <= 0.5001e-4


def test_contributions_add_up_to_the_log_odds(boosted, test_rows):
    shap = explain.tree_shap(boosted, test_rows)
    sums = shap.groupBy("order_id").agg((F.sum("contribution") + F.first("base_value")).alias("total"), F.count("*").alias("n"))
    odds = models.scored(boosted, test_rows).select("order_id", F.log(F.col("prob") / (1 - F.col("prob"))).alias("odds"))
    joined = sums.join(odds, "order_id").collect()
    assert len(joined) == 200
    for r in joined:
        assert r["n"] == 17 and r["total"] == pytest.approx(r["odds"], abs=1e-6)


def brute_shap(model, x):
    """Shapley values by enumerating every subset of the inputs in use."""
    from itertools import combinations
    from math import factorial

    def value(at, known):
        i = model.inputs[at]
        if i < 0:
            return model.values[at]
        if i in known:
            return value(model.left[at] if x[i] <= model.thresholds[at] else model.right[at], known)
        left, right = model.left[at], model.right[at]
        return (model.covers[left] * value(left, known) + model.covers[right] * value(right, known)) / model.covers[at]

    def used_below(at):
        return set() if model.inputs[at] < 0 else {int(model.inputs[at])} | used_below(model.left[at]) | used_below(model.right[at])

    out = np.zeros(len(x))
    for root in model.roots.tolist():
        used = sorted(used_below(root))
        m = len(used)
        for i in used:
            rest = [u for u in used if u != i]
            for size in range(m):
                for subset in combinations(rest, size):
                    share = factorial(size) * factorial(m - size - 1) / factorial(m)
                    out[i] += share * (value(root, {*subset, i}) - value(root, set(subset)))
    return out


def test_contributions_match_enumeration(train, test_rows):
    model = models.fit_gbt(train, iters=3, depth=3)
    few = sampling.hash_sample(test_rows, 5)
    shap = explain.tree_shap(model, few).toPandas()
    for order, part in shap.groupby("order_id"):
        part = part.set_index("feature").loc[FEATURES]
        assert np.allclose(part["contribution"], brute_shap(model, part["value"].to_numpy()), atol=1e-9)


def test_shap_tables(boosted, test_rows):
    shap = explain.tree_shap(boosted, test_rows).persist()
    ranks = explain.shap_importance(shap).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(1, 18))
    assert sum(r["top5"] for r in ranks) == 5 and 4 <= sum(r["highlight"] for r in ranks) <= 6
    assert explain.shap_dependence(shap).count() == 3 * 200
    assert explain.shap_dependence(shap, top=None, interactions=False).count() == 17 * 200
    assert {r["interacts_with"] for r in explain.shap_dependence(shap).collect()} <= set(FEATURES)
    scored = models.scored(boosted, test_rows)
    local = explain.shap_local(shap, scored, hash60(F.col("order_id"), "sample")).toPandas()
    for _, part in local.groupby("case"):
        assert len(part) == 10 and "8 other features" in set(part.feature)
        p = part["prob"].iloc[0]
        assert part["contribution"].sum() + part["base_value"].iloc[0] == pytest.approx(np.log(p / (1 - p)), abs=1e-6)


def test_interacting_inputs_equal_those_of_numpy(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.random(600), rng.random(600), rng.integers(0, 2, 600), np.full(600, 3.0)])
    # a works with c, b with nothing, d is constant.
    found = np.column_stack([x[:, 0] * (x[:, 2] - 0.5), np.sin(5 * x[:, 1]), 0.1 * x[:, 2], 0 * x[:, 3]])
    names = ["a", "b", "c", "d"]
    rows = [(i, n, float(x[i, j]), float(found[i, j]), 0.0) for i in range(600) for j, n in enumerate(names)]
    shap = spark.createDataFrame(rows, "order_id long, feature string, value double, contribution double, base_value double")
    got = {r["feature"]: (r["interacts_with"], r["strength"]) for r in explain.shap_interactions(shap, top=None).collect()}
    for j, name in enumerate(names):
        width = np.ptp(x[:, j])
        bins = np.minimum((x[:, j] - x[:, j].min()) / width * 20, 19).astype(int) if width else np.zeros(600, int)
        strength = {}
        for g, other in enumerate(names):
            if g == j:
                continue
            total = 0.0
            for b in np.unique(bins):
                u, v = found[bins == b, j], x[bins == b, g]
                if u.var() * v.var() > 1e-18:
                    total += abs(((u - u.mean()) * (v - v.mean())).mean()) / np.sqrt(u.var() * v.var()) * len(u)
            strength[other] = round(total / 600, 9)
        best = min(strength, key=lambda n: (-strength[n], n))
        assert got[name][0] == best and got[name][1] == pytest.approx(strength[best], abs=1e-8)
    assert got["a"][0] == "c" and got["a"][1] > 0.9


def test_every_row_donates_once_per_repeat(train):
    x = train.select("order_id", F.array("order_amount", "order_hour").alias("x"))
    pairs = permuting.permuted(x, 3).toPandas()
    assert sorted(pairs["rank"]) == list(range(800))
    want = sorted(tuple(v) for v in pairs["x"])
    for r in range(3):
        given = [tuple(d[r]) for d in pairs["donors"]]
        assert sorted(given) == want
        assert sum(a[0] != b[0] for a, b in zip(pairs["x"], given)) > 700


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_the_network_is_a_permutation_of_any_number_of_ranks(n):
    found = [permuting.permutation(np.arange(n), n, key) for key in range(3)]
    assert all(sorted(f) == list(range(n)) for f in found)
    # Any part of the ranks gives the same places.
    assert (permuting.permutation(np.arange(n)[::3], n, 1) == found[1][::3]).all()
    if n > 100:
        assert not (found[0] == found[1]).all() and abs(np.corrcoef(np.arange(n), found[0])[0, 1]) < 0.15


def test_permutation_drops_equal_those_of_plain_numpy(spark, train):
    # The rule flag as the model: a row is suspected from an amount or an hour on.
    names = ["order_amount", "order_hour", "account_age_days"]
    rows = train.select("is_fraud", *names)

    def flag(x):
        return ((x[:, 0] > 100) & (x[:, 1] < 12)).astype(float)

    got = {r["feature"]: (r["mean_drop"], r["std_drop"]) for r in permuting.accuracy_drops(rows, names, flag, 4, 0.5).collect()}
    held = permuting.permuted(rows.select("is_fraud", F.array(*[F.col(c).cast("double") for c in names]).alias("x")), 4).toPandas()
    x, y = np.array(held["x"].tolist()), held["is_fraud"].to_numpy()
    donors = np.array([[list(v) for v in d] for d in held["donors"]])
    base = (flag(x) == y).mean()
    for i, name in enumerate(names):
        drops = []
        for r in range(4):
            changed = x.copy()
            changed[:, i] = donors[:, r, i]
            drops.append(base - (flag(changed) == y).mean())
        assert got[name] == (pytest.approx(np.mean(drops), abs=1e-12), pytest.approx(np.std(drops), abs=1e-12))
    assert got["account_age_days"] == (0.0, 0.0) and abs(got["order_amount"][0]) > 0
    assert permuting.accuracy_drops(rows.where("false"), names, flag, 2, 0.5).count() == 0


def test_nothing_but_counts_leaves_the_scoring(test_rows, boosted):
    found = permuting.accuracy_drops(test_rows, FEATURES, boosted.probability, 2, 0.5)
    assert found._jdf.queryExecution().executedPlan().toString().count("Window") == 0


def test_permutation_importance_is_zero_for_an_unused_input(boosted, test_rows):
    used = boosted.importance()
    drops = {r["feature"]: r["mean_drop"] for r in models.permutation_importance(boosted, test_rows, repeats=2).collect()}
    assert len(drops) == 17
    assert all(drops[name] == 0 for name, v in zip(FEATURES, used) if v == 0)


def test_train_publish_and_score_again(spark, small_dir, folder):
    mart = tables.mart(spark, small_dir)
    first = modelling.train(mart, folder, iters=2)
    metrics = {r["metric"]: r["value"] for r in first["ml_metrics"].collect()}
    assert metrics["baseline_auc"] == 0.631 and len(metrics) == 6
    before = sorted(map(tuple, first["ml_predictions"].collect()))
    again = modelling.predict(mart, folder)
    assert sorted(map(tuple, again["ml_predictions"].collect())) == before
    assert {r["metric"]: r["value"] for r in again["ml_metrics"].collect()} == metrics


def test_a_missing_model_is_named(spark, small_dir, folder):
    with pytest.raises(FileNotFoundError, match="train a model first"):
        modelling.predict(tables.mart(spark, small_dir), f"{folder}/nothing")


def test_comparisons(train, test_rows):
    table = models.model_comparison(train, test_rows, iters=2, trees=3, max_iter=20).collect()
    assert len(table) == 5 and table[0]["winner"] and sum(r["winner"] for r in table) == 1
    auc = [r["roc_auc"] for r in table]
    assert auc == sorted(auc, reverse=True)
    strategies = models.imbalance_comparison(train, test_rows, max_iter=20).collect()
    assert len(strategies) == 4
    best = ",".join(r["best_for"] for r in strategies if r["best_for"])
    assert sorted(best.split(",")) == sorted(["roc_auc", "avg_precision", "fraud_f1", "fraud_precision", "fraud_recall"])


def test_orders_without_a_label_are_scored(spark, small_dir, boosted):
    mart = tables.mart(spark, small_dir)
    assert models.predict(boosted, mart.drop("is_fraud")).collect() == models.predict(boosted, mart).collect()


def test_a_missing_metrics_file_is_named_before_scoring(spark, small_dir, boosted, folder):
    models.save_model(boosted, f"{folder}/model")
    with pytest.raises(FileNotFoundError, match="metrics.json"):
        modelling.predict(tables.mart(spark, small_dir), folder)


def test_contributions_of_deep_paths_add_up():
    # Fifteen inputs on one path; every subset counts.
    rng = np.random.default_rng(0)
    path = {i: (0.0, np.inf, share) for i, share in enumerate(rng.uniform(0.1, 0.9, 15))}
    leaf = explain.stacked([(path, 2.0)])
    x = np.where(rng.random((20, 15)) < 0.8, 1.0, -1.0)
    parts = explain.contributions(x, [leaf])
    reached = (x > 0).all(axis=1) * 2.0
    assert np.allclose(parts.sum(axis=1), reached - 2.0 * leaf.share.prod())


def test_the_boosted_model_beats_chance(spark, sf_dir):
    rows = sampling.stratified_split(features.feature_matrix(tables.mart(spark, sf_dir)))
    train, test = rows.where(~F.col("is_test")).drop("is_test"), rows.where("is_test").drop("is_test")
    found = models.evaluate_model(models.fit_gbt(train, iters=20), test).first()
    assert found["roc_auc"] > 0.55


def test_fits_of_short_passes_run_side_by_side_and_metrics_are_taken_once(train, test_rows, boosted, monkeypatch):
    met, taken = threading.Barrier(2, timeout=60), []
    metrics_of = models._metrics_of
    monkeypatch.setattr(models, "fit_gbt", lambda *_, **__: (met.wait(), boosted)[1])
    monkeypatch.setattr(models, "_metrics_of", lambda counts: (taken.append(1), metrics_of(counts))[1])
    fitted = {models.LINEAR: models.fit_logistic(features.fit_scaler(train).transform(train), True, 5)}
    table, counts, made = models.compare_models(train, test_rows, 2, 2, 5, fitted)
    assert list(counts) == list(models.model_fits()) and made[models.LINEAR] is fitted[models.LINEAR]
    assert table.count() == 5 and len(taken) == 4


def test_the_registered_comparison_saves_what_other_queries_load(spark, small_dir, boosted, monkeypatch, folder):
    monkeypatch.setattr(tables, "_written", set())
    monkeypatch.setattr(tables, "folder", lambda spark, d, name: f"{folder}/{name}")
    asked = []

    def compared(train, test, fitted):
        asked.append(sorted(fitted))
        return train.limit(1), {}, {models.FOREST: boosted, models.BOOSTED: boosted}

    monkeypatch.setattr(models, "compare_models", compared)
    for _ in range(2):
        model_queries.model_comparison(spark, small_dir)
    assert asked == [[], sorted([models.FOREST, models.BOOSTED])]
    assert (model_queries._model(spark, small_dir).thresholds == boosted.thresholds).all()


def test_a_pass_carries_few_bytes_of_a_tree():
    tree = boosting.Growing()
    nodes = [0]
    for node in nodes[:]:
        nodes += tree.split(node, 0, 3, 1.0)
    for node in nodes[1:3]:
        tree.split(node, 1, 0, 1.0)
    assert sum(c.nbytes for c in tree.shape()) == 16 * 7
    column, following = boosting.steps(tree.shape(), [[0], [1, 2]], [9, 2, 4])
    assert column[:3].tolist() == [0, 1, 1]
    assert following.reshape(7, 256)[0, :9].tolist() == [1] * 4 + [2] * 5 and following.reshape(7, 256)[1, :8].tolist() == [3] * 4 + [4] * 4

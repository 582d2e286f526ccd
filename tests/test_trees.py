"""Boosting and forests against plain numpy, and the same however rows are dealt."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderrisk.operators import boosting, explain, features, forest, models, sampling, trees
from orderrisk.registry import tables
from orderrisk.session import forget_shuffles

NAMES = ["a", "b", "c"]


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.exponential(50, n).round(2), rng.integers(0, 24, n), rng.random(n) < 0.3]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] / 40 + (x[:, 1] > 18) - 3 * x[:, 2] - 1)))).astype(int)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, int(t), *map(float, v)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "order_id long, is_fraud int, a double, b double, c double").repartition(parts)


def plain_boosting(x, y, cuts, weights, rounds, depth, step, l2, min_curvature):
    """Recursive, in floating point, one row list a node."""
    w = np.where(y == 1, weights[1], weights[0])
    base = np.log(w[y == 1].sum() / w[y == 0].sum())
    margin = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        add = np.zeros(len(y))

        def score(s):
            return g[s].sum() ** 2 / (h[s].sum() + l2)

        def grow(s, level):
            best = (1e-6, None)
            if level < depth:
                for i, cut in enumerate(cuts):
                    for c in cut:
                        left, right = s[x[s, i] <= c], s[x[s, i] > c]
                        if min(len(left), len(right)) and min(h[left].sum(), h[right].sum()) >= min_curvature:
                            gain = score(left) + score(right) - score(s)
                            if gain > best[0] + 1e-9 * best[0]:
                                best = (gain, (left, right))
            if best[1]:
                for part in best[1]:
                    grow(part, level + 1)
            else:
                add[s] = -step * g[s].sum() / (h[s].sum() + l2)

        grow(np.arange(len(y)), 0)
        margin += add
    return 1 / (1 + np.exp(-margin))


def test_boosting_equals_plain_numpy(spark):
    x, y = rows_of(1000)
    train = frame(spark, x, y)
    cuts = boosting.cut_points(train, NAMES, 1000, 16)
    model = boosting.fit(train, NAMES, (1.0, 2.5), rounds=6, depth=3, bins=16)
    want = plain_boosting(x, y, cuts, (1.0, 2.5), 6, 3, 0.3, 1.0, 1.0)
    assert np.allclose(model.probability(x), want, atol=1e-6)


def test_models_do_not_depend_on_how_rows_were_dealt(spark, monkeypatch):
    x, y = rows_of(3000, 1)
    found = []
    for pieces in (1, 9, 70):
        train = frame(spark, x, y, pieces % 8 + 1)
        one = boosting.fit(train, NAMES, (1.0, 3.0), rounds=3, depth=4, pieces=pieces)
        other = forest.fit(train, NAMES, (1.0, 3.0), 8, 8, pieces=pieces, local_rows=400)
        found.append((one.probability(x), other.probability(x)))
    # Seventy pieces meet in groups before the driver sums them.
    assert all((a == b).all() for more in found[1:] for a, b in zip(found[0], more))


def test_small_nodes_grow_the_same_trees_in_a_task_as_by_histograms(spark):
    x, y = rows_of(2000, 2)
    train = frame(spark, x, y)
    made = [forest.fit(train, NAMES, (1.0, 2.0), 6, 7, local_rows=n).probability(x) for n in (0, 300, 10_000)]
    assert np.allclose(made[0], made[1]) and np.allclose(made[0], made[2])


def test_a_forest_counts_rows_by_poisson_draws():
    keys = np.arange(20_000)
    drawn = np.array([forest.times(keys, t) for t in range(5)])
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.03
    assert abs(np.corrcoef(drawn[0], drawn[1])[0, 1]) < 0.03
    picked = forest.drawn_inputs(np.arange(4000) % 7, np.arange(4000), 17, 4)
    assert all(len(set(p)) == 4 for p in picked) and np.bincount(picked.ravel(), minlength=17).std() < 80


def test_forest_leaves_are_the_weighted_shares_of_their_rows(spark):
    x, y = rows_of(1500, 3)
    weights = np.array([1.0, 2.0])
    model = forest.fit(frame(spark, x, y), NAMES, (1.0, 2.0), 3, 5)
    for t, root in enumerate(model.roots.tolist()):
        drawn = forest.times(np.arange(len(y)), t)
        at = np.full(len(y), root)
        for _ in range(model.depth):
            at = np.where(x[np.arange(len(y)), model.inputs[at]] <= model.thresholds[at], model.left[at], model.right[at])
        for leaf in np.unique(at):
            mass = np.bincount(y[at == leaf], drawn[at == leaf], 2) * weights
            if mass.sum():
                assert model.values[leaf] == pytest.approx(mass[1] / mass.sum())
            assert model.covers[leaf] == pytest.approx(mass.sum())


def test_one_class_few_rows_and_missing_inputs(spark, folder):
    x, y = rows_of(40, 4)
    assert (boosting.fit(frame(spark, x, y * 0), NAMES, rounds=2).probability(x) < 0.5).all()
    assert (forest.fit(frame(spark, x, y * 0), NAMES, count=2).probability(x) == 0).all()
    none = boosting.fit(frame(spark, x, y).where("false"), NAMES)
    assert (none.probability(x) == 0.5).all()
    same = boosting.fit(frame(spark, x[:1].repeat(40, axis=0), y), NAMES, rounds=2)
    assert len(same.inputs) == 2
    broken = frame(spark, x, y).withColumn("b", F.when(F.col("order_id") != 3, F.col("b")))
    with pytest.raises(Exception, match="missing input"):
        boosting.fit(broken, NAMES, rounds=1)


def test_models_are_saved_and_loaded(spark, folder):
    x, y = rows_of(200, 5)
    model = boosting.fit(frame(spark, x, y), NAMES, rounds=2, depth=3)
    trees.save(model, f"{folder}/trees")
    again = trees.load(f"{folder}/trees")
    assert (again.probability(x) == model.probability(x)).all() and again.names == NAMES
    assert again.importance().sum() == pytest.approx(1.0)


def test_both_models_beat_chance(spark, sf_dir):
    rows = sampling.stratified_split(features.feature_matrix(tables.mart(spark, sf_dir))).persist()
    train, test = rows.where(~F.col("is_test")).drop("is_test"), rows.where("is_test").drop("is_test")
    for model in (models.fit_gbt(train, iters=10), models.fit_forest(train, 20)):
        assert models.evaluate_model(model, test).first()["roc_auc"] > 0.55


def random_model(x, depth, count=12, link="logistic"):
    rng = np.random.default_rng(7)
    made = []
    for _ in range(count):
        tree = {c: [] for c in ("input", "threshold", "left", "right", "value", "cover", "gain")}

        def add(rows, left_over, tree=tree):
            node = len(tree["input"])
            for column, value in zip(tree, (-1, 0.0, node, node, rng.normal(), float(len(rows)), 1.0)):
                tree[column].append(value)
            i = int(rng.integers(0, x.shape[1]))
            cut = float(rng.choice(x[rows, i]))
            parts = rows[x[rows, i] <= cut], rows[x[rows, i] > cut]
            if left_over and min(map(len, parts)) > 1:
                tree["input"][node], tree["threshold"][node] = i, cut
                tree["left"][node], tree["right"][node] = (add(part, left_over - 1) for part in parts)
            return node

        add(np.arange(len(x)), depth)
        made.append(tree)
    return trees.grown([f"i{k}" for k in range(x.shape[1])], link, 0.25, made)


def test_tabled_contributions_equal_those_of_the_rule(monkeypatch):
    x = np.random.default_rng(1).normal(size=(300, 9)).round(1)
    groups = explain.leaves_of(random_model(x, 8))[0]
    assert max(held.inputs.shape[1] for held in groups) > explain._TABLED
    tabled = explain.prepared(groups)(x)
    monkeypatch.setattr(explain, "_TABLED", 0)
    assert np.allclose(tabled, explain.prepared(groups)(x), rtol=0, atol=1e-12)


def test_replaced_values_score_like_whole_changed_rows():
    x = np.random.default_rng(2).normal(size=(2000, 5)).round(1)
    for depth, masked in ((5, True), (11, False)):
        for link in ("logistic", "mean"):
            model = random_model(x, depth, link=link)
            assert (model.kept_leaves is not None) == masked
            for f, changed in enumerate(model.replaced(x)):
                other = x.copy()
                other[:, f] = x[::-1, f]
                assert (changed(other[:, f]) == model.probability(other)).all()


def test_a_pass_sums_one_child_of_a_split_and_few_columns(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.exponential(50, 900).round(2), rng.integers(0, 24, 900), rng.random(900) < 0.3]).astype(float)
    y = (rng.random(900) < 0.2 + 0.5 * (x[:, 1] > 12)).astype(int)
    sizes, seen = [255, 24, 2], []
    assert boosting.bundles(sizes) == [[0], [1, 2]]
    summed = boosting.summed
    monkeypatch.setattr(boosting, "summed", lambda found, size: (seen.append(out := summed(found, size)), out)[1])
    model = boosting.fit(frame(spark, x, y), NAMES, (1.0, 2.5), rounds=2, depth=3)
    nodes = [len(total) for total in seen]
    assert nodes[0] == 1 and nodes[1] == 1 and max(nodes) <= 2
    cuts = boosting.cut_points(frame(spark, x, y), NAMES, 900)
    assert np.allclose(model.probability(x), plain_boosting(x, y, cuts, (1.0, 2.5), 2, 3, 0.3, 1.0, 1.0), atol=1e-6)


def test_finished_trees_of_a_forest_are_flat_arrays(spark):
    x, y = rows_of(600, 8)
    tree = forest.Tree(counts=[np.bincount(y, minlength=2)])
    flat = forest._compact(tree, [np.zeros(0)] * 3, np.array([1.0, 2.0]))
    assert all(isinstance(v, np.ndarray) for v in flat.values())
    assert flat["cover"][0] == (y == 0).sum() + 2 * y.sum() and flat["value"][0] == 2 * y.sum() / flat["cover"][0]


def test_trees_whose_rows_fit_a_task_grow_without_passes(spark, monkeypatch):
    x, y = rows_of(900, 9)
    train, passes = frame(spark, x, y), []
    summed = forest.summed
    monkeypatch.setattr(forest, "summed", lambda found, size: (passes.append(size), summed(found, size))[1])
    whole = forest.fit(train, NAMES, (1.0, 2.0), 5, 6)
    assert not passes
    in_passes = forest.fit(train, NAMES, (1.0, 2.0), 5, 6, local_rows=0)
    assert len(passes) == 6
    assert (whole.probability(x) == in_passes.probability(x)).all() and sorted(whole.gains) == sorted(in_passes.gains)


@pytest.mark.parametrize("sizes", [[255, 24, 2, 5, 1], [200] * 9 + [3, 40]])
def test_rows_of_a_forest_are_words_with_all_inputs(sizes):
    rng = np.random.default_rng(10)
    together = boosting.bundles(sizes)
    layout = forest.Layout(together, sizes)
    assert layout.words == (1 if len(sizes) == 5 else 2)
    bins = np.array([rng.integers(0, size, 700) for size in sizes])
    labels, count = rng.integers(0, 2, 700).astype(np.uint8), rng.poisson(1.0, 700)
    codes = np.concatenate([sum(bins[i] * s for i, s in zip(b, boosting.strides(b, sizes), strict=True)) for b in together]).astype(np.uint8)
    rows = layout.drawn(layout.rows(labels, codes), count)
    assert len(rows) == (count > 0).sum() and layout.counts(rows).tolist() == [count[labels == c].sum() for c in (0, 1)]
    found = layout.histogram(rows, np.arange(len(sizes)))
    for i, size in enumerate(sizes):
        want = np.zeros((256, 2), int)
        np.add.at(want, (bins[i], labels), count)
        assert (found[i] == want).all()
        left, right = layout.parts(rows, i, size // 3)
        assert len(left) == ((bins[i] <= size // 3) & (count > 0)).sum() and len(left) + len(right) == len(rows)


def test_draws_are_found_by_their_upper_bits():
    keys = np.random.default_rng(11).integers(-(1 << 62), 1 << 62, 200_000)
    mixed = forest._mixed(keys.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + forest._mixed(np.full(1, 4, np.uint64)))
    want = np.searchsorted(forest._POISSON, (mixed >> np.uint64(11)).astype(float) / (1 << 53), "right")
    assert (forest.times(keys, 3) == want).all() and (forest._UPPER < 0).sum() < 20


def test_shuffles_that_nothing_names_are_removed(spark):
    held = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    moved = spark.sparkContext.parallelize([(i % 3, b"row") for i in range(30)], 3).partitionBy(3)
    assert moved.count() == 30
    before = held.size()
    del moved
    for _ in range(50):
        forget_shuffles(spark)
        if held.size() < before:
            return
        time.sleep(0.2)
    raise AssertionError("the shuffle is still there")

"""Splits, samples, neighbours and oversampling against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderrisk.operators import neighbours, sampling
from orderrisk.operators.features import FEATURES, feature_matrix, fit_scaler
from orderrisk.registry import tables


def counts(df, *names):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*names).count().collect()}


def labelled(spark, n, positives):
    return spark.range(n).select(
        F.col("id").alias("order_id"), F.when(F.col("id") < positives, 1).otherwise(0).alias("is_fraud")
    )


@pytest.mark.parametrize(("rows", "positives", "want"), [(1000, 50, (10, 190)), (101, 7, (1, 20)), (13, 13, (3, 0))])
def test_split_sizes(spark, rows, positives, want):
    split = sampling.stratified_split(labelled(spark, rows, positives))
    got = counts(split.where("is_test"), "is_fraud")
    assert (got.get((1,), 0), got.get((0,), 0)) == want
    assert split.count() == rows


def test_split_does_not_depend_on_partitions(spark):
    df = labelled(spark, 500, 60)
    a = sorted(map(tuple, sampling.stratified_split(df).collect()))
    assert a == sorted(map(tuple, sampling.stratified_split(df.repartition(7)).collect()))


def test_undersampling_is_one_to_one_and_keeps_all_positives(spark):
    assert counts(sampling.undersample(labelled(spark, 800, 90)), "is_fraud") == {(0,): 90, (1,): 90}
    assert counts(sampling.undersample(labelled(spark, 100, 80)), "is_fraud") == {(0,): 20, (1,): 80}


def test_hash_sample_is_fixed_and_short_inputs_stay_whole(spark):
    df = labelled(spark, 300, 10)
    first = sorted(r["order_id"] for r in sampling.hash_sample(df, 40).collect())
    assert len(first) == 40 and first != list(range(40))
    assert first == sorted(r["order_id"] for r in sampling.hash_sample(df.repartition(5), 40).collect())
    assert sampling.hash_sample(df, 1000).count() == 300


def points_frame(spark, vectors, mults=None):
    rows = [(i, [float(x) for x in v], int((mults or [1] * len(vectors))[i])) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id bigint, vec array<double>, mult bigint")


def brute(vectors, k):
    dist = np.sqrt(((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(dist, np.inf)
    return np.argsort(dist, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("shape", ["uniform", "clusters", "one dense cluster"])
@pytest.mark.parametrize("block_rows", [16, 100, 4096])
def test_neighbours_are_exact(spark, shape, block_rows):
    rng = np.random.default_rng(5)
    if shape == "uniform":
        vectors = rng.random((300, 4))
    elif shape == "clusters":
        vectors = np.concatenate([rng.normal(c, 0.1, (60, 4)) for c in (0, 3, 3.4, 9, 20)])
    else:
        vectors = np.concatenate([rng.normal(0, 1e-3, (200, 4)), rng.normal(0, 5, (100, 4))])
    found = neighbours.nearest_distinct(points_frame(spark, vectors), 5, block_rows)
    got = {}
    for r in found.orderBy("id", "_place").collect():
        got.setdefault(r["id"], []).append(r["nid"])
    want = brute(vectors, 5)
    assert all(got[i] == want[i].tolist() for i in range(len(vectors)))


def test_neighbours_with_copies_and_few_points(spark):
    frame = points_frame(spark, [[0, 0], [1, 0], [5, 0]], [3, 1, 1])
    got = {r["id"]: r["neighbours"] for r in neighbours.nearest_neighbours(frame, 3).collect()}
    assert got[0] == [[0, 0], [0, 0], [1, 0]]
    assert got[1] == [[0, 0], [0, 0], [0, 0]]
    assert got[2] == [[1, 0], [0, 0], [0, 0]]
    alone = neighbours.nearest_neighbours(points_frame(spark, [[0, 0]]), 3).first()
    assert alone["neighbours"] == []


def test_points_visit_few_leaves_and_twice_the_points_much_less_than_four_times(spark, sf_dir):
    rows = feature_matrix(tables.mart(spark, sf_dir))
    vectors = fit_scaler(rows).transform(rows).select(*[F.col(f"`{c}`") for c in FEATURES]).toPandas().to_numpy()
    visits = []
    for n in (2000, 4000):
        points = points_frame(spark, np.unique(vectors[:n], axis=0))
        placed, levels = neighbours.box_tree(points, 5, 17, 64)
        assert placed.count() == n and placed.groupBy("leaf").count().where("count > 64").count() == 0
        _, bounded = neighbours.within_leaves(placed, 5, 17)
        sent = neighbours.visits(bounded, levels).persist()
        assert sent.count() == sent.select("id", "leaf").distinct().count()
        visits.append(sent.count())
    leaves = placed.select("leaf").distinct().count()
    assert leaves > 4000 / 64 and visits[1] < 4000 * leaves / 5
    assert visits[1] < 3 * visits[0]


def test_a_leaf_with_many_visitors_is_dealt_over_slices(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE_ROWS", 8)
    vectors = np.random.default_rng(2).random((200, 3))
    found = neighbours.nearest_distinct(points_frame(spark, vectors), 4, 20).orderBy("id", "_place").collect()
    assert [r["nid"] for r in found] == brute(vectors, 4).ravel().tolist()


def test_points_meet_all_boxes_within_their_limit_in_slices(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SLICE_ROWS", 8)
    vectors = np.random.default_rng(3).random((200, 3))
    placed, levels = neighbours.box_tree(points_frame(spark, vectors), 4, 3, 20)
    _, bounded = neighbours.within_leaves(placed, 4, 3)
    sent = neighbours.visits(bounded, levels).select("id", "limit", "leaf").collect()
    leaves = [r for level in levels for r in level.where("is_leaf").collect()]
    want = set()
    for r in bounded.collect():
        x = np.array(r["vec"])
        for leaf in leaves:
            gap = np.maximum(np.maximum(np.array(leaf["low"]) - x, x - np.array(leaf["high"])), 0)
            if leaf["node"] != r["home"] and np.sqrt((gap**2).sum()) <= r["limit"]:
                want.add((r["id"], r["limit"], leaf["node"]))
    assert len(sent) == len(want) and set(map(tuple, sent)) == want


def test_only_neighbours_within_the_limit_leave_a_task():
    right = pd.DataFrame({"id": [1, 2, 3, 4], "vec": [[1.0], [2.0], [3.0], [4.0]], "mult": 1})
    left = pd.DataFrame({"id": [7, 8, 9], "vec": [[0.0], [0.5], [9.0]], "limit": [2.0, np.inf, 4.0]})
    found = neighbours._best(left, right, 3, 1)
    assert found[["id", "nid"]].to_numpy().tolist() == [[7, 1], [7, 2], [8, 1], [8, 2], [8, 3]]


def test_no_points_have_no_neighbours(spark):
    assert neighbours.nearest_distinct(points_frame(spark, [[0, 0]]).where("false"), 3).count() == 0


def test_smote_balances_and_interpolates(spark, small_dir):
    train = feature_matrix(tables.mart(spark, small_dir))
    scaled = fit_scaler(train).transform(train)
    made = sampling.smote(scaled, FEATURES)
    assert counts(made, "is_fraud") == {(0,): 950, (1,): 950}
    assert made.where("copy = 0").count() == 1000
    pdf = scaled.where("is_fraud = 1").select("order_id", *[F.col(f"`{c}`") for c in FEATURES]).toPandas()
    vectors = pdf[FEATURES].to_numpy()
    near = brute(vectors, 5)
    place = {order: i for i, order in enumerate(pdf["order_id"])}
    synthetic = made.where("copy > 0").toPandas()
    assert len(synthetic) == 900
    uses = synthetic.groupby("order_id").size()
    assert set(uses) == {18} and len(uses) == 50
    for row in synthetic.itertuples(index=False):
        x, start = np.array(row[3:], dtype=float), place[row[0]]
        best = np.inf
        for j in near[start]:
            a, b = vectors[start], vectors[j]
            along = np.clip(((x - a) @ (b - a)) / max(((b - a) @ (b - a)), 1e-300), 0, 1)
            best = min(best, np.abs(x - (a + along * (b - a))).max())
        assert best < 1e-9


def test_smote_spreads_many_copies_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_BLOCK", 7)
    df = labelled(spark, 200, 3).withColumn("x", F.col("order_id").cast("double"))
    made = sampling.smote(df, ["x"], k=2)
    assert counts(made, "is_fraud") == {(0,): 197, (1,): 197}
    assert made.where("copy > 0").select("order_id", "copy").distinct().count() == 194


def test_too_few_positives_are_refused(spark):
    rows = spark.range(50).selectExpr("id as order_id", "if(id < 3, 1, 0) as is_fraud", "cast(id as double) as x")
    with pytest.raises(ValueError, match="too few"):
        sampling.smote(rows, ["x"])

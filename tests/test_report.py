"""Report and exploration tables on hand-made marts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.numbers import percent_half_up, ratio_half_up
from orderrisk.operators import eda, quantiles, report
from orderrisk.plans import reporting
from orderrisk.registry import tables


def test_ratios_round_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 8, 1), (1, 80, 1), (0, 5, 2), (3, 0, 1), (2, 3, 2)], "n int, d int, p int")
    got = df.select(ratio_half_up(F.col("n"), F.col("d"), 2), percent_half_up(F.col("n"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [(0.13, 12.5), (0.01, 1.3), (0.0, 0.0), (None, None), (0.67, 66.7)]


def test_empty_mart(spark, small_dir):
    empty = tables.mart(spark, small_dir).where("false")
    assert report.summary(empty).first()["total_orders"] == 0
    assert [r["hits"] for r in report.rule_hits(empty).collect()] == [0] * 8
    assert [r["bar_width"] for r in report.rule_hits_scaled(empty).collect()] == [0.0] * 8
    assert eda.rate_by_age(empty).count() == 6


def test_missing_predictions_count_as_zero_and_the_top_is_a_top(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    flagged = [r["order_id"] for r in mart.where("fraud_flag = 1").orderBy("order_id").collect()]
    chosen = flagged[-3:]
    preds = spark.createDataFrame(
        [(i, 0.9 - n / 10, 1) for n, i in enumerate(chosen)], "order_id bigint, ml_fraud_prob double, ml_fraud_flag int"
    )
    top = report.flagged_top(mart, preds).collect()
    assert [r["order_id"] for r in top] == chosen + flagged[:47]
    assert {r["ml_fraud_prob"] for r in top[3:]} == {0.0}
    assert report.flagged_top(mart, preds, n=2).count() == 2


def test_report_without_model(spark, small_dir):
    out = reporting.report_tables(tables.mart(spark, small_dir))
    assert [r["value"] for r in out["ml_metric_cards"].collect()] == ["N/A"] * 6
    assert tuple(out["ml_summary"].first()) == (None, 0.0, 0)
    assert out["flagged_top50"].count() == 50


def test_filters_combine(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    top = report.flagged_top(mart, tables.stand_in_predictions(mart))
    assert report.flagged_filter(top).first()["visible"] == 50
    rows = report.flagged_filter(top, tier="high", category="Travel").collect()
    assert {(r["risk_tier"], r["product_category"]) for r in rows} == {("high", "Travel")}
    assert {r["visible"] for r in rows} == {len(rows)}


def test_histogram_agrees_with_numpy(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    pdf = mart.select("is_fraud", "order_amount", "risk_score").toPandas()
    for column, bins, clip, density in [("order_amount", 60, 100.0, False), ("risk_score", 30, None, True)]:
        rows = eda.histogram(mart, column, bins, clip=clip, density=density).orderBy("is_fraud", "bin").toPandas()
        for label in (0, 1):
            values = pdf.loc[pdf.is_fraud == label, column]
            want, edges = np.histogram(values.clip(upper=clip) if clip else values, bins=bins)
            part = rows[rows.is_fraud == label]
            assert part.orders.tolist() == want.tolist()
            assert np.allclose(part.lower, edges[:-1]) and np.allclose(part.upper, edges[1:])
            if density:
                assert np.allclose(part.density, np.histogram(values, bins=bins, density=True)[0])


def test_histogram_of_a_single_value(spark):
    df = spark.createDataFrame([(0, 5.0), (0, 5.0)], "is_fraud int, order_amount double")
    rows = eda.histogram(df, "order_amount", 4).orderBy("bin").collect()
    assert [r["orders"] for r in rows] == np.histogram([5.0, 5.0], bins=4)[0].tolist()


def test_describe_agrees_with_pandas(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    pdf = mart.select("is_fraud", "order_amount").toPandas()
    want = pdf.groupby("is_fraud")["order_amount"].describe()
    for row in eda.amount_describe(mart).collect():
        expected = want.loc[row["is_fraud"]]
        assert row["count"] == expected["count"]
        for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert row[ours] == pytest.approx(expected[theirs], abs=0.0051)


def test_sketched_quartiles_are_near_in_rank(spark, small_dir):
    n = 1_000_000
    df = spark.range(n).select(F.pmod("id", F.lit(3)).alias("g"), F.when(F.col("id") % 10 != 0, F.pow(F.rand(4), F.lit(3)) * 1e4).alias("v")).persist()
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    rows = quantiles.sketched_quantiles(df, ["g"], F.col("v"), shares).collect()
    assert len(rows) == 15
    for r in rows:
        group = df.where((F.col("g") == r["g"]) & F.col("v").isNotNull())
        rank = group.where(F.col("v") <= r["quantile"]).count() / group.count()
        assert rank == pytest.approx(r["share"], abs=0.0026)
    mart = tables.mart(spark, small_dir)
    exact = {r["is_fraud"]: r for r in eda.amount_describe(mart).collect()}
    for r in eda.amount_describe_sketched(mart).collect():
        want = exact[r["is_fraud"]]
        assert r.asDict().keys() == want.asDict().keys()
        assert {c: r[c] for c in ("count", "mean", "std", "min", "max")} == {c: want[c] for c in ("count", "mean", "std", "min", "max")}
        # A sketch names a value that occurs; between the values of few rows lies more than between those of many.
        few = mart.where(F.col("is_fraud") == r["is_fraud"]).count() < 500
        assert all(r[c] == pytest.approx(want[c], rel=0.2 if few else 0.03) for c in ("q25", "q50", "q75"))
    df.unpersist()


def test_correlations_with_values_that_are_no_numbers(spark):
    rows = spark.range(100).selectExpr("if(id = 3, double('nan'), id * 1D) as a", "id * 2D as b", "if(id = 5, double('inf'), 100 - id) as c")
    found = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in eda.correlations(rows, ["a", "b", "c"]).collect()}
    assert found["b", "b"] == 1.0
    assert all(found[x, y] is None or math.isnan(found[x, y]) for x in "ac" for y in "abc")


def test_correlations_agree_with_pandas(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    want = mart.select(*fixed.CORRELATION_COLUMNS).toPandas().corr()
    rows = eda.correlations(mart).collect()
    assert len(rows) == 64
    for row in rows:
        assert row["correlation"] == pytest.approx(want.loc[row["feature_a"], row["feature_b"]], abs=1e-6)


def test_age_buckets_and_negative_age(spark):
    df = spark.createDataFrame([(-1, 1), (0, 1), (6, 0), (7, 1), (729, 0), (5000, 1)], "account_age_days int, is_fraud int")
    got = {r["age_bucket"]: (r["fraud_rate"], r["orders"]) for r in eda.rate_by_age(df).collect()}
    assert got["<7d"] == (0.5, 2) and got["7-30d"] == (1.0, 1) and got["1y+"] == (0.5, 2)
    assert got["30-90d"] == (None, 0)


def test_correlations_of_large_and_constant_values(spark):
    rows = spark.range(2000).selectExpr("1e9D + id / 1000D as a", "1e9D - id / 1000D + pmod(id, 7) / 1e5D as b", "0.1D as c")
    found = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in eda.correlations(rows, ["a", "b", "c"]).collect()}
    assert found["a", "a"] == 1.0
    assert found["a", "b"] == pytest.approx(-1.0, abs=1e-6)
    assert all(found["c", x] is None for x in "abc")

"""Rules, joins and skew handling on hand-made orders."""

import datetime

import pytest
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.operators import customers, rules, scoring, staging
from orderrisk.operators.skew import spread_join
from orderrisk.registry import tables

SCHEMA = (
    "order_id bigint, customer_id string, order_date string, order_hour string, order_amount string,"
    " payment_method string, product_category string, billing_country string, shipping_country string,"
    " ip_country string, is_new_customer string, account_age_days string, is_fraud string"
)


def order(order_id, **changes):
    row = {
        "order_id": order_id,
        "customer_id": f"c{order_id}",
        "order_date": "2024-06-01",
        "order_hour": "12",
        "order_amount": "50.0",
        "payment_method": "visa",
        "product_category": "Clothing",
        "billing_country": "US",
        "shipping_country": "US",
        "ip_country": "US",
        "is_new_customer": "False",
        "account_age_days": "365",
        "is_fraud": "0",
    }
    row.update(changes)
    return tuple(row.values())


def staged(spark, rows):
    return staging.stage(spark.createDataFrame(rows, SCHEMA))


def mart_of(spark, rows, **options):
    return {r["order_id"]: r for r in scoring.fct_fraud_signals(staged(spark, rows), **options).collect()}


def test_boundary_cases_of_the_variant(spark):
    rows = []
    for number, (changes, _, _) in enumerate(fixed.BOUNDARY_CASES, start=1):
        rows.append({**fixed.BOUNDARY_BASE, **changes, "order_id": number, "customer_id": 9000 + number})
    feed = spark.createDataFrame(rows)
    got = {r["order_id"]: (r["risk_score"], r["fraud_flag"]) for r in scoring.score_variant(staging.stage(feed)).collect()}
    want = {n: (s, f) for n, (_, s, f) in enumerate(fixed.BOUNDARY_CASES, start=1)}
    assert got == want


def test_mart_rules_one_by_one_and_tiers(spark):
    got = mart_of(
        spark,
        [
            order(1),
            order(2, order_amount="150.00"),
            order(3, order_amount="149.99"),
            order(4, product_category="Travel"),
            order(5, account_age_days="29"),
            order(6, account_age_days="30"),
            order(7, order_hour="1"),
            order(8, order_hour="5"),
            order(9, order_hour="0"),
            order(10, is_new_customer="1", order_amount="100"),
            order(11, shipping_country="CA"),
            order(12, ip_country="NG", shipping_country="CA"),
            order(13, ip_country="NG", shipping_country="CA", account_age_days="3"),
        ],
    )
    scores = [got[i]["risk_score"] for i in range(1, 14)]
    assert scores == [0, 20, 0, 15, 30, 0, 10, 10, 0, 20, 25, 50, 80]
    assert [got[i]["risk_tier"] for i in (1, 11, 12, 13)] == ["none", "low", "medium", "high"]
    assert [got[i]["fraud_flag"] for i in (1, 11, 12, 13)] == [0, 0, 1, 1]


def test_velocity_needs_three_orders_on_a_day(spark):
    two = [order(i, customer_id="two") for i in (1, 2)]
    three = [order(i, customer_id="three") for i in (3, 4, 5)]
    other_day = [order(6, customer_id="two", order_date="2024-06-02")]
    got = mart_of(spark, two + three + other_day)
    assert {i: got[i]["orders_on_day"] for i in got} == {1: 2, 2: 2, 3: 3, 4: 3, 5: 3, 6: 1}
    assert [got[i]["high_velocity"] for i in (1, 3)] == [False, True]
    assert [got[i]["risk_score"] for i in (1, 3)] == [0, 20]


def test_null_flags_score_nothing_and_null_keys_drop_out(spark):
    got = mart_of(
        spark,
        [
            order(1, shipping_country=None, ip_country=None, account_age_days=None, order_amount=None),
            order(2, customer_id=None),
            order(3, order_date=None),
            order(4, is_new_customer=None, order_amount="120"),
        ],
    )
    assert set(got) == {1, 4}
    assert got[1]["risk_score"] == 0 and got[1]["country_mismatch"] is None
    assert got[4]["risk_score"] == 0


def test_a_null_date_counts_in_the_profile_but_not_in_the_mart(spark):
    rows = [order(1, customer_id="c", order_amount="10"), order(2, customer_id="c", order_amount="20", order_date=None)]
    got = mart_of(spark, rows)
    assert set(got) == {1} and got[1]["customer_avg_order_amount"] == 15.0


def test_empty_feed(spark):
    stg = staged(spark, [])
    assert scoring.fct_fraud_signals(stg).count() == 0
    assert customers.risk_profile(stg).count() == 0


def test_broken_values_are_refused(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staged(spark, [order(1, order_amount="ten")]).collect()


def test_averages_round_half_up_at_the_cent(spark):
    rows = [order(1, customer_id="c", order_amount="1.00"), order(2, customer_id="c", order_amount="1.01")]
    assert mart_of(spark, rows)[1]["customer_avg_order_amount"] == 1.01


@pytest.mark.parametrize("task_rows", [1, 2, 7])
def test_hot_keys_give_the_same_rows(spark, small_dir, task_rows):
    stg = tables.stg(spark, small_dir)
    plain = sorted(map(tuple, scoring.fct_fraud_signals(stg).collect()))
    assert sorted(map(tuple, scoring.fct_fraud_signals(stg, task_rows=task_rows).collect())) == plain
    plain = sorted(map(tuple, customers.order_velocity(stg).collect()))
    assert sorted(map(tuple, customers.order_velocity(stg, task_rows=task_rows).collect())) == plain


def test_a_hot_key_is_spread_over_the_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts = spark.range(4000).select(
            F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("key")
        )
        lookup = facts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        joined = spread_join(facts, lookup, ["key"], "n", "order_id", task_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 4000
        assert max(sizes) < 4000 / 3
        assert joined.where("key = -1").agg(F.min("n"), F.max("n")).first()[0] == 2666
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_results_do_not_depend_on_partitioning(spark, small_dir):
    stg = tables.stg(spark, small_dir)
    want = sorted(map(tuple, scoring.fct_fraud_signals(stg).collect()))
    spread = stg.repartition(13, "order_hour")
    assert sorted(map(tuple, scoring.fct_fraud_signals(spread).collect())) == want


def test_rule_attributions_add_up(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    mean = mart.agg(F.avg("risk_score")).first()[0]
    sums = rules.rule_attribution(mart, rules.MART_RULES).groupBy("order_id").agg(
        F.sum("attribution").alias("a"), F.sum("points").alias("p")
    )
    joined = sums.join(mart.select("order_id", "risk_score"), "order_id").collect()
    assert len(joined) == 1000
    for row in joined:
        assert row["p"] == row["risk_score"]
        assert row["a"] == pytest.approx(row["risk_score"] - mean, abs=1e-9)


def test_scores_stay_in_range_and_tiers_cover_all(spark, sf_dir):
    mart = tables.mart(spark, sf_dir)
    low, high = mart.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert low >= 0 and high <= fixed.MAX_SCORE
    assert sum(r["count"] for r in mart.groupBy("risk_tier").count().collect()) == mart.count()


def test_dates_are_dates(spark):
    assert staged(spark, [order(1)]).first()["order_date"] == datetime.date(2024, 6, 1)

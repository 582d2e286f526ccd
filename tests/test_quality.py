"""Checks find what they should find."""

import pytest
from pyspark.sql import functions as F

from orderrisk.operators import quality
from orderrisk.plans import build
from orderrisk.registry import tables
from orderrisk.session import cut_lineage
from orderrisk.sources import feeds, files


def results(df):
    return {(r["model"], r["column"], r["test"]): r["failures"] for r in df.collect()}


def test_failures_are_counted(spark):
    df = spark.createDataFrame(
        [(1, "visa", "Travel"), (1, "cash", None), (2, "cash", "Toys"), (None, "gold", "Food"), (None, None, "Toys")],
        "order_id bigint, payment_method string, product_category string",
    )
    suite = {
        "m": {
            "not_null": ["order_id", "payment_method", "product_category"],
            "unique": ["order_id"],
            "accepted_values": {"payment_method": ["visa"], "product_category": ["Travel"]},
        }
    }
    got = results(quality.run_suite({"m": df}, suite))
    assert got == {
        ("m", "order_id", "not_null"): 2,
        ("m", "payment_method", "not_null"): 1,
        ("m", "product_category", "not_null"): 1,
        ("m", "order_id", "unique"): 1,
        ("m", "payment_method", "accepted_values"): 2,
        ("m", "product_category", "accepted_values"): 2,
    }


def test_checks_while_writing_equal_those_on_the_table(spark):
    df = spark.createDataFrame(
        [(1, "visa", "Travel"), (1, "cash", None), (2, "cash", "Toys"), (None, "gold", "Food"), (None, None, "Toys"), (5, "visa", "Travel")],
        "order_id bigint, payment_method string, product_category string",
    )
    suite = {
        "m": {
            "not_null": ["order_id", "payment_method", "product_category"],
            "unique": ["order_id"],
            "accepted_values": {"payment_method": ["visa"], "product_category": ["Travel"], "order_id": [1, 2, 5]},
        },
        "keys": {"unique": ["order_id"]},
    }
    writes = []

    def write(table):
        writes.append(table)
        return cut_lineage(table)

    for rows in (df, df.where("order_id = 5"), df.where("false")):
        for model in suite:
            written, found = quality.written_and_checked(rows, model, write, suite)
            assert results(found) == results(quality.run_suite({model: rows}, suite))
            assert written.count() == rows.count()
    assert len(writes) == 6


def test_a_broken_feed_names_every_check(spark, small_dir, folder):
    feed = feeds.orders(spark, small_dir)
    broken = feed.withColumn("payment_method", F.when(F.col("order_id") < 3, "gold").when(F.col("order_id") != 7, F.col("payment_method")))
    with pytest.raises(quality.QualityError) as raised:
        build.build_mart(broken, f"{folder}/mart")
    assert str(raised.value) == "stg_transactions.payment_method accepted_values: 1; stg_transactions.payment_method not_null: 1"
    twice = feed.where("order_id < 4").union(feed)
    with pytest.raises(quality.QualityError, match="order_id unique: "):
        build.build_mart(twice, f"{folder}/twice")
    assert not files.exists(spark, f"{folder}/twice")
    assert build.build_mart(feed, f"{folder}/mart").count() == 1000


def test_the_suite_has_twenty_checks_and_the_feed_passes(spark, small_dir):
    from orderrisk.registry.core_queries import _suite_tables

    outcome = quality.run_suite(_suite_tables(spark, small_dir))
    assert outcome.count() == 20
    quality.require(outcome)


def test_gate_raises_and_names_the_check(spark, small_dir):
    stg = tables.stg(spark, small_dir)
    twice = stg.union(stg)
    with pytest.raises(quality.QualityError, match="stg_transactions.order_id unique: 1000"):
        quality.require(quality.unique(twice, "stg_transactions", "order_id"))


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "order_id bigint")
    assert results(quality.run_suite({"m": df}, {"m": {"not_null": ["order_id"], "unique": ["order_id"]}})) == {
        ("m", "order_id", "not_null"): 0,
        ("m", "order_id", "unique"): 0,
    }

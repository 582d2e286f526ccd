"""The shape of the physical plans, and the jobs from feed to report."""

import json
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderrisk import __main__ as cli
from orderrisk.operators import quality, sampling, scoring
from orderrisk.plans import build, reporting
from orderrisk.registry import core_queries, model_queries, tables
from orderrisk.sources import feeds, files


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["report_summary", "tier_distribution", "rule_hits", "rule_hits_scaled", "rule_precision_recall", "correlations"],
)
def test_one_scan_and_only_the_needed_columns(name, spark, small_dir):
    plan = plan_of(core_queries.QUERIES[name](spark, small_dir))
    assert plan.count("FileScan parquet") == 1
    scan = plan[plan.index("ReadSchema: ") :].split(">")[0]
    assert "shipping_country" not in scan and "customer_id" not in scan


LAZY = sorted(
    set(core_queries.QUERIES) | {"feature_matrix", "stratified_split", "class_weights", "undersample", "shap_sample"}
)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python_workers(name, spark, small_dir):
    plan = plan_of(entry.queries()[name](spark, small_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan, word


def test_the_flagged_list_is_a_top_k_over_a_narrow_join(spark, small_dir):
    plan = plan_of(core_queries.flagged_top50(spark, small_dir))
    assert plan.count("TakeOrderedAndProject") == 2
    assert "TakeOrderedAndProject" in plan_of(model_queries.shap_sample(spark, small_dir))


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    plan = plan_of(mart.where("fraud_flag = 1").select("order_id"))
    assert "EqualTo(fraud_flag,1)" in plan and "ReadSchema: struct<order_id:bigint,fraud_flag:int>" in plan


def test_the_mart_shuffles_the_orders_once(spark, small_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = core_queries.fct_fraud_signals(spark, small_dir)
        df.collect()
        final = plan_of(df).split("Initial Plan")[0]
        wide = [
            line
            for line in final.splitlines()
            if "Exchange hashpartitioning" in line and "_slot" in line
        ]
        # One exchange for the orders, one for the customer-day table.
        assert len(wide) == 2
        assert "ReusedExchange" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_from_card_feed_to_report(spark, small_dir, folder):
    cards = feeds.card_txns(spark, small_dir)
    files.write_csv(cards, f"{folder}/cards")
    cli.main(["reshape", "--cards", f"{folder}/cards", "--orders", f"{folder}/orders"], spark)
    cli.main(["build", "--orders", f"{folder}/orders", "--mart", f"{folder}/mart"], spark)
    mart = files.read_table(spark, f"{folder}/mart")
    assert mart.count() == 1000 and len(mart.columns) == 22
    assert dict(mart.dtypes)["order_id"] == "string"
    cli.main(["report", "--mart", f"{folder}/mart", "--out", f"{folder}/out"], spark)
    cards_before = files.read_table(spark, f"{folder}/out/report/ml_metric_cards").collect()
    assert {r["value"] for r in cards_before} == {"N/A"}
    for job in ("train", "predict"):
        cli.main([job, "--mart", f"{folder}/mart", "--out", f"{folder}/out", "--iters", "2"], spark)
    cli.main(["explain", "--mart", f"{folder}/mart", "--out", f"{folder}/out"], spark)
    cli.main(["report", "--mart", f"{folder}/mart", "--out", f"{folder}/out"], spark)
    cards_after = files.read_table(spark, f"{folder}/out/report/ml_metric_cards").collect()
    assert "N/A" not in {r["value"] for r in cards_after}
    assert files.read_table(spark, f"{folder}/out/shap_importance").count() == 17
    export = spark.read.option("header", True).csv(f"{folder}/out/report/flagged_export")
    assert export.count() == min(50, mart.where("fraud_flag = 1").count())
    assert spark.table("int_customer_risk_profile").count() == mart.select("customer_id").distinct().count()


def test_the_export_shows_what_the_filters_show(spark, small_dir):
    mart = tables.mart(spark, small_dir)
    whole = reporting.report_tables(mart)["flagged_export"].collect()
    tier, payment = whole[0][-1], whole[0][4]
    some = reporting.report_tables(mart, tier=tier, payment=payment)["flagged_export"].collect()
    assert some == [r for r in whole if r[-1] == tier and r[4] == payment] and 0 < len(some) < len(whole)


def test_the_stress_job_names_what_fails(spark, small_dir, folder, monkeypatch):
    files.write_csv(feeds.stress_orders(spark, small_dir), f"{folder}/orders")
    cli.main(["stress", "--orders", f"{folder}/orders", "--out", f"{folder}/out"], spark)
    assert files.read_table(spark, f"{folder}/out/rule_coverage").where("not fires").count() == 0
    assert files.read_table(spark, f"{folder}/out/score_boundaries").count() == 10
    few = files.read_orders(spark, f"{folder}/orders", labelled=False).where("payment_method != 'crypto'")
    with pytest.raises(quality.QualityError, match="rule .* never fires"):
        build.stress(few)
    cases = [(changes, score + (i == 3), flag) for i, (changes, score, flag) in enumerate(scoring.fixed.BOUNDARY_CASES)]
    monkeypatch.setattr(scoring.fixed, "BOUNDARY_CASES", cases)
    with pytest.raises(quality.QualityError, match="boundary case 4 is scored"):
        build.stress(files.read_orders(spark, f"{folder}/orders", labelled=False))


def test_a_cut_reads_its_rows_twice_and_marks_them_once(spark, small_dir):
    labelled = tables.mart(spark, small_dir).select("order_id", "is_fraud")
    df = sampling.stratified_split(labelled)
    # The counts are written before; one scan looks at one prefix, one marks.
    assert plan_of(df).count("ReadSchema: struct<order_id") == 2


def test_a_write_that_fails_leaves_the_old_table(spark, folder):
    path = f"{folder}/table"
    spark.range(5).write.parquet(path)
    assert files.read_table(spark, path).count() == 5
    assert files.write_table(spark.range(7), path).count() == 7
    held = files.read_table(spark, path)
    broken = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('half way'), id) as id")
    with pytest.raises(Exception, match="half way"):
        files.write_table(broken, path)
    assert files.read_table(spark, path).count() == 7
    files.write_table(spark.range(9), path)
    # A reader of the table before is not disturbed by one write.
    assert held.count() == 7 and files.read_table(spark, path).count() == 9
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2


def test_the_metrics_file_is_one_flat_object(spark, small_dir):
    core_queries.metrics_long(spark, small_dir)
    text = spark.read.text(tables.folder(spark, small_dir, "metrics_json")).agg(F.first("value")).first()[0]
    assert sorted(json.loads(text)) == sorted(
        ["roc_auc", "avg_precision", "fraud_f1", "baseline_auc", "baseline_ap", "baseline_f1"]
    )

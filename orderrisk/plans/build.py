"""From a feed to the checked, materialized mart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from orderrisk.functions import fixed_values as fixed
from orderrisk.operators import customers, quality, reshape, rules, scoring, staging
from orderrisk.session import cut_lineage
from orderrisk.sources import files


def reshape_cards(spark: SparkSession, card_csv: str, orders_csv: str) -> DataFrame:
    """Card feed to order feed, written as CSV; returns the profile of what was written."""
    files.write_csv(reshape.reshape_card_txns(files.read_card_txns(spark, card_csv)), orders_csv)
    return reshape.reshape_profile(
        staging.stage(files.read_orders(spark, orders_csv)).selectExpr(
            "billing_country", "product_category", "is_fraud", "cast(is_new_customer as int) as is_new_customer"
        )
    )


def tables_of(stg: DataFrame) -> dict[str, DataFrame]:
    """Velocity, profile and mart of a staged feed; nothing runs yet."""
    return {
        "int_customer_order_velocity": customers.order_velocity(stg),
        "int_customer_risk_profile": customers.risk_profile(stg),
        "fct_fraud_signals": scoring.fct_fraud_signals(stg),
    }


def build_mart(orders: DataFrame, mart_path: str, check: bool = True) -> DataFrame:
    """Writes the mart as a table and registers the other tables as views.

    With ``check`` every table is written once, the others in the shared folder, and checked while it is written. The ids
    come first, since a repeated order id would be scored twice. All checks that failed are named together.
    """
    stg = staging.stage(orders)
    if not check:
        tables = {"stg_transactions": stg, **tables_of(stg)}
        tables["fct_fraud_signals"] = files.write_table(tables["fct_fraud_signals"], mart_path)
        files.register_views(tables)
        return tables["fct_fraud_signals"]
    stg, found = quality.written_and_checked(stg, "stg_transactions", cut_lineage)
    quality.require(found.where("test = 'unique'"))
    tables, results = {"stg_transactions": stg}, [found]
    for model, df in tables_of(stg).items():
        last = model == "fct_fraud_signals"
        tables[model], found = quality.written_and_checked(df, model, (lambda t: files.write_table(t, mart_path)) if last else cut_lineage)
        results.append(found)
    files.register_views(tables)
    quality.require(reduce(DataFrame.unionByName, results))
    return tables["fct_fraud_signals"]


def stress(orders: DataFrame) -> dict[str, DataFrame]:
    """Scores a feed with the variant rules; raises if a rule never fires or a boundary case is scored wrong.

    The boundary cases are replayed by as many orders as the feed has. Both tables have one row per rule or case.
    """
    stg = staging.stage(orders)
    coverage = cut_lineage(rules.rule_coverage(scoring.score_variant(stg), rules.VARIANT_RULES, fixed.COVERAGE_RULE_LABELS))
    cases = cut_lineage(scoring.boundary_report(stg.select("order_id")))
    silent = [f"rule {r['rule']} never fires" for r in coverage.where("not fires").collect()]
    wrong = [f"boundary case {r['case_id']} is scored {r['risk_score']}" for r in cases.where("as_expected < orders").collect()]
    if silent or wrong:
        raise quality.QualityError("; ".join(sorted([*silent, *wrong])))
    return {"rule_coverage": coverage, "score_boundaries": cases}

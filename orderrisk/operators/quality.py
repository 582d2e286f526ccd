"""Declarative checks as aggregate jobs: (model, column, test, failures) rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions import text

# The suite. 20 checks on four tables.
SUITE = {
    "stg_transactions": {
        "not_null": [
            "order_id",
            "customer_id",
            "order_date",
            "order_amount",
            "payment_method",
            "product_category",
        ],
        "unique": ["order_id"],
        "accepted_values": {
            "payment_method": fixed.PAYMENT_METHODS,
            "product_category": fixed.PRODUCT_CATEGORIES,
        },
    },
    "int_customer_order_velocity": {"not_null": ["order_id"], "unique": ["order_id"]},
    "int_customer_risk_profile": {"not_null": ["customer_id"], "unique": ["customer_id"]},
    "fct_fraud_signals": {
        "not_null": ["order_id", "fraud_flag", "risk_tier", "risk_score"],
        "unique": ["order_id"],
        "accepted_values": {"fraud_flag": fixed.FRAUD_FLAGS, "risk_tier": fixed.RISK_TIERS},
    },
}


class QualityError(ValueError):
    """At least one check found failures."""


def _as_rows(one_row: DataFrame, model: str, test: str, columns: list[str]) -> DataFrame:
    lines = [
        {
            "model": text.literal(model),
            "column": text.literal(column),
            "test": text.literal(test),
            "failures": text.name(column),
        }
        for column in columns
    ]
    return one_row.selectExpr(text.rows(lines))


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Null rows per column, all columns in one scan."""
    nulls = df.selectExpr(*[f"count_if({column} is null) as {column}" for column in columns])
    return _as_rows(nulls, model, "not_null", columns)


def unique(df: DataFrame, model: str, key: str) -> DataFrame:
    """Keys that occur more than once; nulls do not count."""
    repeated = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    return _as_rows(repeated.agg(F.count(F.lit(1)).alias(key)), model, "unique", [key])


def accepted_values(df: DataFrame, model: str, accepted: dict[str, list]) -> DataFrame:
    """Distinct values outside the list, per column, all columns in one scan.

    Only values that fail are passed on, so clean data shuffles nothing.
    """

    suspects = []
    for column, values in accepted.items():
        words = ", ".join(text.literal(value) for value in values)
        value = f"case when {column} not in ({words}) then cast({column} as string) end"
        suspects.append({"column": text.literal(column), "value": value})
    failing = df.selectExpr(text.rows(suspects)).where("value is not null").distinct()
    counts = failing.selectExpr(
        *[f"count_if(column = {text.literal(column)}) as {column}" for column in accepted]
    )
    return _as_rows(counts, model, "accepted_values", list(accepted))


def run_suite(tables: dict[str, DataFrame], suite: dict | None = None, tests: set[str] | None = None) -> DataFrame:
    """All checks of the suite (or those named in ``tests``) as one table."""
    parts = []
    for model, checks in (suite or SUITE).items():
        if model not in tables:
            continue
        df = tables[model]
        if "not_null" in checks and (tests is None or "not_null" in tests):
            parts.append(not_null(df, model, checks["not_null"]))
        if tests is None or "unique" in tests:
            parts.extend(unique(df, model, key) for key in checks.get("unique", []))
        if "accepted_values" in checks and (tests is None or "accepted_values" in tests):
            parts.append(accepted_values(df, model, checks["accepted_values"]))
    return reduce(DataFrame.unionByName, parts)


def written_and_checked(df: DataFrame, model: str, write: Callable[[DataFrame], DataFrame], suite: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """The written table and its check results: nulls and values outside their list are counted while ``write`` runs.

    Keys take one grouped pass over what was written. Only if a value is outside its list is the table read again, to
    count how many different ones there are.
    """
    checks = (suite or SUITE)[model]
    nulls, accepted = checks.get("not_null", []), checks.get("accepted_values", {})
    spark = df.sparkSession
    seen: dict[str, int] = {}
    if nulls or accepted:
        watch = Observation(model)
        bad = [f"count_if({column} not in ({', '.join(text.literal(v) for v in values)})) as bad_{column}" for column, values in accepted.items()]
        written = write(df.observe(watch, *[F.expr(f"count_if({column} is null) as null_{column}") for column in nulls], *map(F.expr, bad)))
        seen = watch.get
    else:
        written = write(df)
    rows = [(model, column, "not_null", int(seen[f"null_{column}"])) for column in nulls]
    rows += [(model, column, "accepted_values", 0) for column in accepted if not seen[f"bad_{column}"]]
    parts = [spark.createDataFrame(rows, "model string, column string, test string, failures bigint")]
    parts += [unique(written, model, key) for key in checks.get("unique", [])]
    failing = {column: values for column, values in accepted.items() if seen[f"bad_{column}"]}
    if failing:
        parts.append(accepted_values(written, model, failing))
    return written, reduce(DataFrame.unionByName, parts)


def require(results: DataFrame) -> None:
    """Raise when any check failed. The result table has one row per check."""
    failed = results.where(F.col("failures") > 0).collect()
    if failed:
        lines = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed]
        raise QualityError("; ".join(sorted(lines)))

"""The tables that the registered queries start from."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.operators import scoring, staging
from orderrisk.session import scratch_dir
from orderrisk.sources import feeds, files

_written: set[str] = set()


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of this application for a table derived from ``sf_dir``."""
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    return f"{scratch_dir(spark)}/{tag}/{name}"


def written_once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write the table on first use in this application, then scan it."""
    path = folder(spark, sf_dir, name)
    if path not in _written:
        files.write_table(build(), path)
        _written.add(path)
    return files.read_table(spark, path)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(feeds.orders(spark, sf_dir))


def stress_stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(feeds.stress_orders(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored mart, materialized as a table: report, exploration and models read it."""
    return written_once(
        spark, sf_dir, "fct_fraud_signals", lambda: scoring.fct_fraud_signals(stg(spark, sf_dir))
    )


def stand_in_predictions(mart_df: DataFrame) -> DataFrame:
    """Predictions that SQL can check: the rule score as a share of its maximum."""
    share = F.col("risk_score") / F.lit(float(fixed.MAX_SCORE))
    return mart_df.select(
        "order_id",
        (F.rint(share * 10_000.0) / 10_000.0).alias("ml_fraud_prob"),
        F.when(share >= fixed.MODEL_FLAG_AT, 1).otherwise(0).alias("ml_fraud_flag"),
    )

"""CSV, JSON and Parquet in and out."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderrisk.functions import fixed_values as fixed

ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_hour",
    "order_amount",
    "payment_method",
    "product_category",
    "billing_country",
    "shipping_country",
    "ip_country",
    "is_new_customer",
    "account_age_days",
    "is_fraud",
]

# Columns used out of the much wider card file, with their types.
CARD_COLUMNS = {
    "TransactionID": "bigint",
    "TransactionDT": "bigint",
    "TransactionAmt": "double",
    "ProductCD": "string",
    "card1": "double",
    "card4": "string",
    "addr2": "double",
    "P_emaildomain": "string",
    "R_emaildomain": "string",
    "D1": "double",
    "isFraud": "int",
}


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header, every field as text, columns found by name, broken rows refused.

    Types are not sniffed: that would scan the files twice and could differ from run to run.
    """
    return (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
        .select(*columns)
    )


def read_orders(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """The 13-column order feed as text, or 12 columns without the label; ``staging.stage`` casts it."""
    return read_csv_text(spark, path, ORDER_COLUMNS if labelled else ORDER_COLUMNS[:-1])


def read_card_txns(spark: SparkSession, path: str) -> DataFrame:
    """The card transaction feed, cut to the columns in use and typed."""
    text = read_csv_text(spark, path, list(CARD_COLUMNS))
    return text.select(*[F.col(name).cast(kind).alias(name) for name, kind in CARD_COLUMNS.items()])


def write_csv(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """CSV with a header; quotes inside fields are doubled."""
    df.write.mode("overwrite").csv(path, header=True, quoteAll=quote_all, escape='"', emptyValue="")


_POINTER = "_current"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create or replace a Parquet table and return a scan of it.

    Each write goes to a folder of its own below ``path``, and a small pointer file is swapped to it last. A write that fails
    leaves the old table as it is; readers of the old one are not disturbed until the next write, which
    removes all folders but the last two.
    """
    spark = df.sparkSession
    fs, root = _place(spark, path)
    jvm = spark._jvm.org.apache.hadoop.fs
    before = _version(spark, path)
    name = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{name}")
    fresh = jvm.Path(f"{path}/.{_POINTER}-{name}")
    out = fs.create(fresh, True)
    out.writeBytes(name)
    out.close()
    pointer = jvm.Path(f"{path}/{_POINTER}")
    # Not every store replaces a file by renaming; there the pointer is away for a moment, and readers take the last version.
    if not _replaced(spark, fs, fresh, pointer):
        fs.delete(pointer, False)
        fs.rename(fresh, pointer)
    for status in fs.listStatus(root):
        old = status.getPath().getName()
        # Plain files of a table that was written another way are replaced as well.
        if old not in (name, before, _POINTER) and (before is None or old.startswith("v-")):
            fs.delete(status.getPath(), True)
    return spark.read.parquet(f"{path}/{name}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`write_table` wrote last, or plain Parquet files."""
    name = _version(spark, path)
    return spark.read.parquet(f"{path}/{name}" if name else path)


def _place(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _replaced(spark: SparkSession, fs, source, target) -> bool:
    try:
        files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
        over = spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        files.rename(fs.makeQualified(source), fs.makeQualified(target), over)
    except Py4JError:
        return False
    return True


def _version(spark: SparkSession, path: str) -> str | None:
    """The folder that the pointer names; the last one that was finished if the pointer is being swapped; None for no such table."""
    fs, root = _place(spark, path)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_POINTER}")
    if fs.exists(pointer):
        held = fs.open(pointer)
        try:
            return held.readLine()
        finally:
            held.close()
    if not fs.exists(root):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v-"))
    done = [n for n in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return done[-1] if done else None


def exists(spark: SparkSession, path: str) -> bool:
    fs, root = _place(spark, path)
    return fs.exists(root)


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """One row of metric columns as a flat JSON object."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def metrics_long(spark: SparkSession, json_path: str) -> DataFrame:
    """Flat JSON object to (metric, value) rows."""
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in fixed.METRIC_NAMES])
    flat = spark.read.schema(schema).json(json_path, multiLine=True)
    return flat.unpivot([], fixed.METRIC_NAMES, "metric", "value")

"""Session helpers: a local builder for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_KEY = "orderrisk.scratch"


def local_session(cores: int | str = 8, app: str = "orderrisk") -> SparkSession:
    """A local session for tests and benches. On a cluster pass the cluster's own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ORDERRISK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one named in ``spark.checkpoint.dir``.

    Tables written here survive the loss of an executor. A local session that names no such folder keeps them in its
    warehouse; on a cluster it must be named. The folder goes when the application ends.
    """
    known = spark.conf.get(_SCRATCH_KEY, None)
    if known:
        return known
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a folder that all machines share in spark.checkpoint.dir")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    folder = f"{shared.rstrip('/')}/orderrisk-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    spark.conf.set(_SCRATCH_KEY, folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, safe from lost executors.

    A checkpoint would compute the rows twice and store them row by row; a table is columnar.
    """
    path = f"{scratch_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Removes the files of a table that :func:`cut_lineage` wrote and nothing reads any more."""
    folder = scratch_dir(df.sparkSession)
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
    for table in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        path = hadoop.Path(table)
        if f"{folder.split(':', 1)[-1].lstrip('/')}/cut-" in table:
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the files of shuffles that no DataFrame or RDD names any more: it does so when the driver's two heaps are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

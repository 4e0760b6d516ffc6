"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "reefcensus") -> SparkSession:
    """A session tuned for the survey engine.

    On a cluster the master, shuffle partitions and checkpoint dir come from
    the submit configuration; locally we size shuffles to the cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode runs everything in the driver JVM; clusters size it at submit
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("REEFCENSUS_DRIVER_MEMORY", "8g"))
    local = bool(master and master.startswith("local"))
    if shuffle_partitions or local:
        # locally: one partition per core; on a cluster the submit config sizes it
        builder = builder.config("spark.sql.shuffle.partitions",
                                 str(shuffle_partitions or os.cpu_count() or 8))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when it is unset in local mode (tests) do we pick a scratch folder;
    on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="reefcensus-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back:
    what several branches read is computed once, each branch reads only its
    columns, and a lost executor costs no recomputation."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Tables written once and read again, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefcensus.session import checkpoint_dir


def scratch_path(spark, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    The lineage ends in committed files, so an executor lost later costs no
    recomputation, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` wrote, through Spark's own file
    system. Only for tables that no later job reads: what was made of them
    must be written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_id(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns plus ``rid``, a row number. The number depends on how
    the scan is split, which each job plans anew: it holds within one job
    only. What several jobs read takes ``stored_rows``."""
    return docs.select(F.monotonically_increasing_id().alias("rid"), *cols)


def stored_rows(docs: DataFrame, *cols) -> DataFrame:
    """``with_row_id``, written once, so that all jobs see the same numbers."""
    return materialize(with_row_id(docs, *cols), "rows", "zstd")


def whole_rows(docs: DataFrame) -> DataFrame:
    """``(rid, row)``, written once: ``row`` holds all columns of ``docs``."""
    return stored_rows(docs, F.struct("*").alias("row"))

"""Incremental day builds as a Structured Streaming job.

The survey protocol rebuilds only the days that have no complete table yet
(I1/I2). Here that is a file-source stream over the worksheet folders: each
micro-batch holds only sheets that arrived since the last run; the batch is
turned into grid rows, appended to the grid table, and only the days it
touches are rebuilt and written with dynamic partition overwrite. Run it with
``trigger(availableNow=True)`` as a scheduled job, or continuously.

The stream's checkpoint lives under the shared ``spark.checkpoint.dir``
folder, so a restarted driver (or a lost executor) resumes where it stopped:
a batch is re-run whole, and its writes overwrite the same partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reefcensus.operators.complete import DAY_KEYS, DEPLOYMENT_KEY
from reefcensus.operators.joins import broadcast_if_small
from reefcensus.plans.days import build_days
from reefcensus.session import checkpoint_dir
from reefcensus.sinks import write_day_complete, write_partitioned
from reefcensus.sources.deployments import csv_records, file_columns
from reefcensus.sources.lookups import read_partitioned
from reefcensus.sources.worksheets import sheet_rows


def latest_sheets(grid: DataFrame) -> DataFrame:
    """One copy of each sheet, the one of the latest batch. The file source
    reads a path once: an edited sheet must arrive under a new file (another
    folder level above the expedition), or be rebuilt in batch (I2)."""
    keys = [*DAY_KEYS, "spreadsheet", "sheet"]
    newest = grid.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return grid.join(newest, [*keys, "batch_id"], "inner").drop("batch_id")


def start_day_builds(spark: SparkSession, sheets_root: str, plan_path: str, grid_path: str,
                     complete_path: str, status_path: str, available_now: bool = True,
                     max_files_per_trigger: int = 10_000, name: str = "day-builds") -> StreamingQuery:
    """Stream new worksheet files into the grid table and rebuild their days.

    ``plan_path`` holds the published plans (K5 layout: parquet partitioned
    by expedition and day folder, with family and deployment key columns).
    """
    stream = (spark.readStream
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .text(sheets_root.rstrip("/") + "/*/*/*/*.csv", wholetext=True)
              .select(*file_columns(), "value"))

    def build(batch: DataFrame, batch_id: int) -> None:
        # the batch is read by several branches below; keep it for this batch
        # only (a lost executor just re-reads its files)
        batch = batch.persist()
        try:
            _build(batch, batch_id)
        finally:
            batch.unpersist()

    def _build(batch: DataFrame, batch_id: int) -> None:
        new_rows = sheet_rows(csv_records(batch)).withColumn("batch_id", F.lit(batch_id))
        # A replayed batch overwrites exactly its own partitions: idempotent.
        write_partitioned(new_rows, grid_path, ["batch_id", *DAY_KEYS])
        touched = broadcast_if_small(new_rows.select(*DAY_KEYS).distinct())
        grid = read_partitioned(spark, grid_path, DAY_KEYS).join(touched, DAY_KEYS, "inner")
        grid = latest_sheets(grid)
        meta = read_partitioned(spark, plan_path, DAY_KEYS).join(touched, DAY_KEYS, "inner")
        complete, bad = build_days(meta, grid)
        write_day_complete(complete, complete_path)
        # status of every rebuilt day: its mismatches, or one "ok" row, so a
        # day that became complete clears its old mismatches (a day that turns
        # bad keeps its last complete table, as an aborted rebuild would)
        ok = (touched.join(bad.select(*DAY_KEYS).distinct(), DAY_KEYS, "left_anti")
              .withColumn(DEPLOYMENT_KEY, F.lit(None).cast("string")).withColumn("check", F.lit("ok")))
        status = bad.unionByName(ok).withColumn("batch_id", F.lit(batch_id))
        write_partitioned(status, status_path, DAY_KEYS)

    ckpt = checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    writer = stream.writeStream.foreachBatch(build).option("checkpointLocation", ckpt).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

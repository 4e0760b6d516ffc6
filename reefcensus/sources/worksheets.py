"""A2/A3/A4: worksheet grids.

Filled worksheets arrive as one CSV per sheet under
``root/<expedition>/<day folder>/<spreadsheet>/<sheet>.csv``. They are read
in one job into the grid table ``(expedition, day_folder, spreadsheet,
sheet, row_idx, cells)``; the folder names become columns. Ingest once to
parquet (``write_grid``) and query that: thousands of tiny CSVs are slow to
list, the parquet grid is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefcensus.sinks import DAY_PARTITIONS, write_partitioned
from reefcensus.sources.deployments import read_csv_grid
from reefcensus.sources.lookups import read_partitioned


def sheet_rows(records: DataFrame) -> DataFrame:
    """Grid rows of CSV records; the folders of the path become columns."""
    parts = F.split(F.col("file"), "/")
    n = F.size(parts)

    def part(back: int):
        return F.element_at(parts, n - back + 1)

    sheet = F.regexp_replace(part(1), r"\.csv$", "")
    return records.select(
        part(4).alias("expedition"), part(3).alias("day_folder"), part(2).alias("spreadsheet"),
        sheet.alias("sheet"), "row_idx", "cells",
    )


def read_worksheet_csvs(spark: SparkSession, root: str) -> DataFrame:
    """All sheets under ``root`` as a worksheet grid."""
    return sheet_rows(read_csv_grid(spark, root.rstrip("/") + "/*/*/*/*.csv"))


def write_grid(grid: DataFrame, path: str) -> None:
    """Persist the grid, partitioned by expedition and day (dynamic overwrite
    replaces only the days present in ``grid``)."""
    write_partitioned(grid, path, DAY_PARTITIONS)


def read_grid(spark: SparkSession, path: str, expedition: str | None = None,
              day_folder: str | None = None) -> DataFrame:
    """The parquet grid; expedition/day filters prune partitions."""
    g = read_partitioned(spark, path, DAY_PARTITIONS)
    if expedition is not None:
        g = g.filter(F.col("expedition") == expedition)
    if day_folder is not None:
        g = g.filter(F.col("day_folder") == day_folder)
    return g

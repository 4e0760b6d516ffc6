"""K1-K5: writers. Day-level outputs are partitioned by expedition and day
folder and written with dynamic partition overwrite, so rebuilding some days
replaces exactly those days and leaves the others.

Days differ in their columns. A stored table keeps a register of its schema
(``schemas.register``): a write adds its columns before it writes a row, and
readers take the union, so no footer decides what a table holds."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefcensus.functions.text import na_text
from reefcensus.registry import BACKUP_FLAG_TEXT
from reefcensus.sinks.schemas import as_registered, register

DAY_PARTITIONS = ["expedition", "day_folder"]
MAX_FILE_ROWS = 5_000_000


def _dynamic(df: DataFrame):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _rebalanced(df: DataFrame, parts: list[str]) -> DataFrame:
    """Rows of a partition together; AQE splits large ones over tasks and
    joins small ones, so no day or expedition is bound to one task."""
    return df.hint("rebalance", *[F.col(f"`{p}`") for p in parts])


def write_partitioned(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replaces the partitions that ``df`` holds, in files of bounded rows.
    Columns that the table does not have yet are added to it; a column of
    another type than the stored one stops the write before it begins."""
    df = as_registered(df, register(df.sparkSession, path, df.schema))
    (_dynamic(_rebalanced(df, parts)).option("maxRecordsPerFile", MAX_FILE_ROWS)
     .partitionBy(*parts).parquet(path))


def write_day_complete(df: DataFrame, path: str, group: bool = False) -> None:
    """K1: day tables (``group`` adds the Fish / Invertebrates partition)."""
    parts = DAY_PARTITIONS + (["Group"] if group else [])
    write_partitioned(df, path, parts)


def write_expedition(df: DataFrame, path: str) -> None:
    """K2: the expedition table (all days), partitioned by expedition."""
    write_partitioned(df, path, ["expedition"])


def _flat(df: DataFrame) -> DataFrame:
    """Without the nested columns, which CSV cannot hold."""
    return df.drop(*[f.name for f in df.schema if f.dataType.typeName() in ("map", "array", "struct")])


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H-%M-%S-%f")


def with_backup_flag(df: DataFrame, text: str = BACKUP_FLAG_TEXT) -> DataFrame:
    """K3 content: the constant warning column."""
    return df.withColumn("Flag", F.lit(text))


def write_backup(df: DataFrame, path: str, expedition: str) -> str:
    """K3: CSV backup in ``path/<expedition>/<expedition> - local version
    created <time>``, without nested columns; returns the folder written."""
    out = f"{path.rstrip('/')}/{expedition}/{expedition} - local version created {_stamp()}"
    with_backup_flag(_flat(df)).write.mode("error").option("header", True).option("escape", '"').csv(out)
    return out


def archive_deployments(df: DataFrame, path: str) -> None:
    """K4: cleaned plan tables as CSV, one folder per expedition, day label
    (a missing part reads ``NA``) and time of the call, so earlier archives
    stay. The label replaces any day folder column; nested columns are left out."""
    label = F.concat(na_text("Location"), F.lit(" "), na_text(F.date_format("Date", "yyyy-MM-dd")))
    parts = ["Expedition", "day_folder", "created"]
    stamped = _flat(df).withColumns({"day_folder": label, "created": F.lit(_stamp())})
    (_rebalanced(stamped, parts).write.mode("append").option("header", True).option("escape", '"')
     .partitionBy(*parts).csv(path))


def publish_metadata(df: DataFrame, path: str) -> None:
    """K5: plan tables published per day for the collection side."""
    write_partitioned(df, path, DAY_PARTITIONS)

"""Lookup scans, stored tables and source pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reefcensus.registry import FISH_SHEET_EXCLUDE, SHEET_ORDER_SHEET, SKIPPED_DAY_FOLDER_NAMES, SKIPPED_SOURCE_NAMES
from reefcensus.sinks import DAY_PARTITIONS
from reefcensus.sinks.schemas import registered_schema


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A lookup CSV as text columns, bound by its header."""
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))


def read_partitioned(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """A stored table with the columns of all its writes; its partition
    columns are text, whatever they look like (``007`` stays ``007``). Tables
    without a register (of other writers) are read by the union of their
    footers."""
    found = registered_schema(spark, path) or spark.read.option("mergeSchema", True).parquet(path).schema
    names = {p.lower() for p in parts}
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name.lower() in names else f for f in found])
    return spark.read.schema(schema).parquet(path)


def read_surveyor_emails(spark: SparkSession, path: str) -> DataFrame:
    """A5: surveyor names and addresses (``FullName, email``)."""
    t = spark.read.parquet(path) if path.endswith(".parquet") else _read_csv(spark, path)
    return t.select("FullName", "email")


def read_species_traits(spark: SparkSession, path: str) -> DataFrame:
    """A5: species length-weight traits (``Species, a, b, IUCN``, more columns kept)."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    t = _read_csv(spark, path)
    return t.withColumn("a", F.col("a").try_cast("double")).withColumn("b", F.col("b").try_cast("double"))


def read_published_metadata(spark: SparkSession, path: str, expedition: str | None = None,
                            day_folder: str | None = None) -> DataFrame:
    """Plan tables published per day (parquet partitioned by expedition
    and day folder); the filters become partition pruning."""
    df = read_partitioned(spark, path, DAY_PARTITIONS)
    if expedition is not None:
        df = df.filter(F.col("expedition") == expedition)
    if day_folder is not None:
        df = df.filter(F.col("day_folder") == day_folder)
    return df


def read_complete_days(spark: SparkSession, path: str, expedition: str | None = None) -> DataFrame:
    """Stored day tables."""
    df = read_partitioned(spark, path, [*DAY_PARTITIONS, "Group"])
    return df if expedition is None else df.filter(F.col("expedition") == expedition)


def read_group_days(spark: SparkSession, path: str, group: str, layout: Sequence[tuple[str, str]],
                    expedition: str | None = None) -> DataFrame:
    """A7 of a two-level table: one group's stored days (partition-pruned) in
    its own layout, behind the day they belong to."""
    df = read_complete_days(spark, path, expedition).filter(F.col("Group") == group)
    return df.select(*DAY_PARTITIONS, *[F.col(f"`{name}`") for name, _ in layout])


def prune_sources(df: DataFrame, name_col: str = "spreadsheet",
                  names: Sequence[str] | None = None,
                  skipped: Sequence[str] = SKIPPED_SOURCE_NAMES) -> DataFrame:
    """Keep the named sources, or, with no list, all but the folders that
    hold no observations (``Metadata``, ``Photos``, ``COMPLETE DATA``)."""
    c = F.col(f"`{name_col}`")
    if names is not None:
        return df.filter(c.isin(list(names)))
    return df.filter(~c.isin(list(skipped)))


def prune_day_folders(df: DataFrame, name_col: str = "day_folder",
                      skipped: Sequence[str] = SKIPPED_DAY_FOLDER_NAMES) -> DataFrame:
    """A8 one level up: folders that stand beside the days of an expedition."""
    return df.filter(~F.col(f"`{name_col}`").isin(list(skipped)))


def prune_sheets(df: DataFrame, sheet_col: str = "sheet", exclude: str = FISH_SHEET_EXCLUDE,
                 include: str | None = None) -> DataFrame:
    """Drop sheets whose name matches ``exclude`` (regex, anywhere) and the
    list of a spreadsheet's tabs, or keep only those matching ``include``."""
    c = F.col(f"`{sheet_col}`")
    if include is not None:
        return df.filter(c.rlike(include))
    return df.filter(~c.rlike(exclude) & (c != SHEET_ORDER_SHEET))

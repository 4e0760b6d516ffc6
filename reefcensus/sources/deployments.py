"""A1: deployment-plan CSV scan.

All plan files of all expeditions are read in one job. Files differ in
column order and naming, so each row is bound to its own file's header by
name (not position): cells -> MAP(header -> value) -> the known columns.
A file that cannot be read as a plan is left out and reported; it never
stops the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reefcensus.functions.dates import parse_day_first
from reefcensus.operators.clean import fill_down, fill_down_except
from reefcensus.operators.headings import bare_names, conflicting_names, missing_names, survey_names
from reefcensus.operators.joins import broadcast_if_small
from reefcensus.registry import DEPLOYMENT_COLUMNS, OBSERVER_COLUMNS, PLAN_REQUIRED

# One field of a CSV record: quoted (a doubled quote stands for one) or plain.
# Atomic: a quoted field is never read again as a plain one up to its first comma.
_FIELD = r'(?>[ \t]*+"[^"]*+(?:""[^"]*+)*+"[ \t]*+(?=,|\r|\n|\z)|[^,\r\n]*+)'
_RECORD = rf"((?:{_FIELD},)*+{_FIELD})(?:\r\n|\n|\r|\z)"
_CELL = rf"({_FIELD}),"


def _cell_value(field: Column) -> Column:
    bare = F.btrim(field, F.lit(" \t"))
    quoted = (F.length(bare) >= 2) & bare.startswith('"') & bare.endswith('"')
    inner = F.replace(F.substr(bare, F.lit(2), F.length(bare) - 2), F.lit('""'), F.lit('"'))
    value = F.when(quoted, inner).otherwise(bare)
    return F.when(value != "", value)


def csv_records(files: DataFrame) -> DataFrame:
    """``(file, file_name, row_idx, cells)`` of whole CSV texts ``(file,
    file_name, value)``; row 0 is the header, blank lines are no records.

    A record has as many cells as it has fields: nothing is cut at a fixed
    width. Quoted fields may hold commas, quotes and line ends. A file is one
    row, so its order needs no window and no shuffle.
    """
    text = F.ltrim(F.col("value"), F.lit("\ufeff"))
    records = F.filter(F.regexp_extract_all(text, F.lit(_RECORD), 1), lambda r: r != "")
    rows = files.select("file", "file_name", F.posexplode(records).alias("row_idx", "record"))
    cells = F.transform(F.regexp_extract_all(F.concat("record", F.lit(",")), F.lit(_CELL), 1), _cell_value)
    return rows.select("file", "file_name", "row_idx", cells.alias("cells"))


def file_columns() -> list[Column]:
    """Decoded path and name of the file a row comes from."""
    return [F.url_decode(F.replace(F.col(f"_metadata.{c}"), F.lit("+"), F.lit("%2B"))).alias(n)
            for c, n in (("file_path", "file"), ("file_name", "file_name"))]


def read_csv_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole CSV texts ``(file, file_name, value)``."""
    return spark.read.text(paths, wholetext=True).select(*file_columns(), "value")


def read_csv_grid(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Any CSV files as ``(file, file_name, row_idx, cells)``."""
    return csv_records(read_csv_files(spark, paths))


def bind_by_header(grid: DataFrame) -> DataFrame:
    """Data rows as ``MAP(heading -> value)`` using each file's own header:
    repaired to be unique, under the survey's names, ``Dive`` dropped. The
    header is worked out once per file."""
    names = survey_names("cells")
    header = grid.filter(F.col("row_idx") == 0).select(
        "file", F.filter(F.transform(names, lambda x, i: F.named_struct(F.lit("at"), i, F.lit("name"), x)),
                         lambda e: e["name"].isNotNull()).alias("header"))
    data = grid.filter(F.col("row_idx") >= 1).join(header, "file", "inner")
    row = F.map_from_arrays(F.transform("header", lambda e: e["name"]),
                            F.transform("header", lambda e: F.try_element_at("cells", e["at"] + 1)))
    return data.select("file", "file_name", "row_idx", row.alias("row"))


def plan_problems(files: DataFrame) -> DataFrame:
    """``(file, check, detail, fatal)`` of plan files ``(file, file_name,
    value)``. A file with a fatal problem cannot be read as a plan: it holds
    no record, two of its headings stand for one column, or a column that
    every plan has is missing. Repeated headings (read as ``name...N``),
    cells without a heading and dates that are none are reported only. Spark
    does not see a file of no bytes."""
    grid = csv_records(files)
    header = grid.filter(F.col("row_idx") == 0).select("file", "cells")
    names = bare_names("cells")
    repeated = F.array_distinct(F.filter(
        names, lambda x, i: (x != "") & (F.array_position(names, x) < i + 1)))
    lists = F.array(
        F.struct(F.lit("conflicting headings").alias("check"), conflicting_names("cells").alias("found"),
                 F.lit(True).alias("fatal")),
        F.struct(F.lit("missing heading").alias("check"), missing_names("cells", PLAN_REQUIRED).alias("found"),
                 F.lit(True).alias("fatal")),
        F.struct(F.lit("repeated headings").alias("check"), repeated.alias("found"), F.lit(False).alias("fatal")))
    by_header = header.select("file", F.inline(lists)).filter(F.size("found") > 0).select(
        "file", "check", F.array_join("found", ", ").alias("detail"), "fatal")
    empty = files.select("file").join(broadcast_if_small(header.select("file")), "file", "left_anti").select(
        "file", F.lit("empty file").alias("check"), F.lit(None).cast("string").alias("detail"), F.lit(True).alias("fatal"))
    # per row: cells past the last heading, and a date text that is no date
    wide = grid.filter(F.col("row_idx") >= 1).join(header.withColumnRenamed("cells", "header"), "file").select(
        "file", "row_idx", "header", "cells",
        F.try_element_at("cells", F.nullif(F.array_position(survey_names("header"), "Date").cast("int"), F.lit(0)))
        .alias("date"))
    beyond = F.exists(F.slice("cells", F.size("header") + 1, F.size("cells")), lambda x: x.isNotNull())
    undated = F.col("date").isNotNull() & parse_day_first("date").isNull()
    by_row = wide.select("file", "row_idx", F.explode(F.array_compact(F.array(
        F.when(beyond, "cells without heading"), F.when(undated, "unreadable date")))).alias("check"))
    by_row = by_row.groupBy("file", "check").agg(F.concat(F.lit("first in row "), F.min("row_idx").cast("string"))
                                                 .alias("detail")).withColumn("fatal", F.lit(False))
    return by_header.unionByName(empty).unionByName(by_row)


def fill_unlisted(rows: DataFrame, known: Sequence[str]) -> DataFrame:
    """``more``: cells under headings outside ``known``, filled down within
    their file like the known columns. Only such cells are shuffled."""
    other = rows.select("file", "row_idx", F.explode(F.map_filter(
        "row", lambda k, v: ~k.isin(list(known)))).alias("k", "v"))
    filled = fill_down(other, ["file", "k"], "row_idx", ["v"]).filter(F.col("v").isNotNull())
    more = filled.groupBy("file", "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("more"))
    return rows.join(more, ["file", "row_idx"], "left")


def plan_rows(files: DataFrame, fill: bool = True, more_columns: Sequence[str] = ()) -> DataFrame:
    """A1 + P1 + P3 + P5 of plan files ``(file, file_name, value)``: the rows
    of every file without a fatal problem."""
    fatal = plan_problems(files).filter("fatal").select("file").distinct()
    good = csv_records(files).join(broadcast_if_small(fatal), "file", "left_anti")
    rows = bind_by_header(good)
    if fill:
        rows = fill_unlisted(rows, DEPLOYMENT_COLUMNS)
    else:
        rows = rows.withColumn("more", F.map_filter("row", lambda k, v: ~k.isin(list(DEPLOYMENT_COLUMNS))))
    wide = rows.select("file", "file_name", "row_idx",
                       *[F.try_element_at("row", F.lit(c)).alias(c) for c in DEPLOYMENT_COLUMNS],
                       *[F.try_element_at("more", F.lit(c)).alias(c) for c in more_columns], "row", "more")
    if fill:
        wide = fill_down_except(wide, ["file"], "row_idx",
                                [*OBSERVER_COLUMNS, "file_name", "row", "more", *more_columns])
    return wide.withColumn("Date", parse_day_first("Date"))


def read_deployments(spark: SparkSession, paths: str | list[str], fill: bool = True,
                     more_columns: Sequence[str] = ()) -> DataFrame:
    """A1 + P1 + P3 + P5: cleaned plan rows of every file that can be read as
    a plan (``read_plan_problems`` names the others and why).

    Blank cells repeat the row above within the file (all columns but the
    two observers, unlisted headings too); comma-only rows stay rows; ``Date``
    is parsed day-first. Headings outside the known ones are in the map
    ``more``, and columns when named in ``more_columns``; every cell as read
    stays in the map ``row``.
    """
    return plan_rows(read_csv_files(spark, paths), fill, more_columns)


def read_plan_problems(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(file, check, detail, fatal)`` of the plan files."""
    return plan_problems(read_csv_files(spark, paths))

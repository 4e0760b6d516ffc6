"""Deployment side, set at once: plan CSVs (or form sheets) of every
expedition -> cleaned plan -> checks -> surveyor table -> expected sheets,
photo folders and access list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefcensus.functions.dates import parse_iso_date
from reefcensus.functions.text import na_text
from reefcensus.operators.checks import missing_counts, single_value_violations, unsupported_projects
from reefcensus.operators.clean import any_present, normalise_headings
from reefcensus.operators.complete import attach_family, metadata_key
from reefcensus.operators.grid import duplicate_metadata_keys, metadata_columns, metadata_map, metadata_pairs
from reefcensus.operators.headings import conflicting_names, survey_names
from reefcensus.operators.joins import broadcast_if_small
from reefcensus.operators.surveyors import (
    access_list,
    photo_manifest,
    surveyor_rows,
    surveyor_tables,
    worksheet_manifest,
)
from reefcensus.registry import (
    DEFAULT_COUNTRY,
    DEPLOYMENT_ANY_PRESENT,
    HEADING_RENAMES,
    OBSERVER_COLUMNS,
)
from reefcensus.sources.deployments import read_csv_files, plan_problems, plan_rows
from reefcensus.sources.lookups import read_published_metadata

PLAN_KEYS = ["file"]


def day_label(location: str = "Location", date: str = "Date"):
    """``"Location YYYY-MM-DD"``, the day folder name (a missing part
    reads ``NA``)."""
    return F.concat(na_text(location), F.lit(" "), na_text(F.date_format(F.col(date), "yyyy-MM-dd")))


def plan_from_csvs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Cleaned plan rows with family, expedition and day folder columns."""
    return _keyed_plan(plan_rows(read_csv_files(spark, paths)))


def _keyed_plan(plan: DataFrame) -> DataFrame:
    plan = attach_family(plan)
    plan = plan.withColumn("expedition", F.col("Expedition")).withColumn("day_folder", day_label())
    return metadata_key(plan)


def plan_checks(plan: DataFrame, by: list[str] = PLAN_KEYS) -> DataFrame:
    """P8 + P9 violations of every plan file, one table."""
    checks = [
        unsupported_projects(plan, by).select(*by, "check", F.col("Project").alias("detail")),
        single_value_violations(plan, by, "Expedition", "one expedition")
        .select(*by, "check", F.concat_ws(" / ", "least_value", "greatest_value").alias("detail")),
        single_value_violations(plan, by, "day_folder", "one location and date")
        .select(*by, "check", F.concat_ws(" / ", "least_value", "greatest_value").alias("detail")),
        single_value_violations(plan, by, "Location", "one location")
        .select(*by, "check", F.concat_ws(" / ", "least_value", "greatest_value").alias("detail")),
        single_value_violations(plan, by, "Project", "one project")
        .select(*by, "check", F.concat_ws(" / ", "least_value", "greatest_value").alias("detail")),
    ]
    missing = missing_counts(plan, by, OBSERVER_COLUMNS)
    checks.append(missing.select(*by, F.lit("missing observer").alias("check"),
                                 F.concat_ws(" / ", *[F.col(f"`missing {c}`").cast("string")
                                                      for c in OBSERVER_COLUMNS]).alias("detail")))
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def plan_products(plan: DataFrame, emails: DataFrame, by: list[str] = PLAN_KEYS) -> dict[str, DataFrame]:
    """Surveyor table (G1, J1, G2) and the R1-R3 manifests."""
    long = surveyor_rows(plan, emails, by)
    return {
        "surveyors": surveyor_tables(plan, emails, by),
        "worksheets": worksheet_manifest(long, by),
        "photos": photo_manifest(long, by),
        "access": access_list(long, by),
    }


FORM_KEYS = ["Country", "Project", "Expedition", "Method", "Location", "Date"]


def form_problems(grid: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, check, detail, fatal)`` of deployment forms: two headings that
    stand for one column (fatal), repeated metadata keys (the first counts)."""
    found = conflicting_names(F.slice("cells", 3, F.greatest(F.size("cells"), F.lit(1))))
    heads = grid.filter(F.col("row_idx") == 0).select(
        *keys, F.lit("conflicting headings").alias("check"), found.alias("found"), F.lit(True).alias("fatal"))
    heads = heads.filter(F.size("found") > 0).select(*keys, "check", F.array_join("found", ", ").alias("detail"), "fatal")
    repeated = duplicate_metadata_keys(metadata_pairs(grid, keys), keys).select(
        *keys, "check", F.col("k").alias("detail"), F.lit(False).alias("fatal"))
    return heads.unionByName(repeated)


def form_to_plan(grid: DataFrame, keys: list[str], project: str | None = None) -> DataFrame:
    """A4 + P6 + P12 + P14 + P1 + P2: deployment form sheets (key/value
    block in columns 1-2, deployment table from column 3) -> plan rows. All
    keys of the form stay in the map ``metadata``, all cells of a table row in
    the map ``row`` and, in order, in ``obs_cells``. Forms with a fatal
    problem (``form_problems``) are left out."""
    from reefcensus.operators.grid import observer_rows

    fatal = form_problems(grid, keys).filter("fatal").select(*keys).distinct()
    grid = grid.join(broadcast_if_small(fatal), list(keys), "left_anti")
    meta = metadata_columns(metadata_map(metadata_pairs(grid, keys), keys), keys, FORM_KEYS)
    meta = meta.withColumn("Date", parse_iso_date("Date"))
    # defaults apply only where the form has no such key at all
    meta = meta.select(
        *[F.col(c) for c in keys],
        *[F.col(c) for c in FORM_KEYS if c not in ("Project", "Country")],
        *[F.when(F.map_contains_key("metadata", c), F.col(c)).otherwise(F.lit(default)).alias(c)
          for c, default in (("Project", project), ("Country", DEFAULT_COUNTRY))],
        "metadata")
    rows = observer_rows(grid, keys, paired=False, required=())
    # the cells under the survey's names; repaired names keep repeated ones apart
    named = survey_names(F.transform("obs_cells", lambda c: c["name"]))
    entries = F.filter(F.arrays_zip(named.alias("k"), F.transform("obs_cells", lambda c: c["value"]).alias("v")),
                       lambda e: e["k"].isNotNull())
    names = ["SiteID", "KnollID", "Spot", "Lat", "Lon", *OBSERVER_COLUMNS,
             "Juveniles First Observer", "Juveniles Second Observer"]
    table = rows.select(*keys, "row_idx", F.map_from_entries(entries).alias("cells"), F.col("obs").alias("row"), "obs_cells")
    table = table.select(*keys, "row_idx", *[F.try_element_at("cells", F.lit(n)).alias(n) for n in names],
                         "row", "obs_cells")
    table = any_present(table, [HEADING_RENAMES.get(c, c) for c in DEPLOYMENT_ANY_PRESENT])
    plan = meta.join(table, list(keys), "inner")
    return normalise_headings(plan).select(
        "Country", "Project", *[c for c in plan.columns if c not in ("Country", "Project")])


def publish_plans(spark: SparkSession, paths: str | list[str], metadata_path: str,
                  archive_path: str | None = None) -> DataFrame:
    """Plan CSVs -> cleaned plans published per day (K5), optionally archived
    as CSV (K4). Returns the plan checks (P8, P9) of the published files and
    the problems of the files as read; a file that is no plan is reported and
    not published, the others are."""
    from reefcensus.sinks import archive_deployments, publish_metadata

    files = read_csv_files(spark, paths)
    problems = plan_problems(files).withColumn(
        "check", F.when(F.col("fatal"), F.concat(F.lit("not read: "), "check")).otherwise(F.col("check")))
    plan = _keyed_plan(plan_rows(files))
    publish_metadata(plan, metadata_path)
    if archive_path is not None:
        archive_deployments(plan.drop("family"), archive_path)
    checks = plan_checks(read_published_metadata(spark, metadata_path))
    return checks.unionByName(problems.select(*PLAN_KEYS, "check", "detail"))

"""Surveyor table and the data products of the deployment side.

G1 deployment lists, J1 email lookups, G2 pair label and email array,
G6 distinct emails, R1 expected-worksheet manifest and its comparison with
the sheets that arrived, R2 photo-folder manifest, R3 access list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefcensus.functions.text import na_text
from reefcensus.operators.clean import number_rows
from reefcensus.operators.joins import broadcast_if_small, conditional_left_join, null_safe_join
from reefcensus.registry import (
    JUVENILE_FAMILIES,
    JUVENILE_OBSERVER_COLUMNS,
    OBSERVER_COLUMNS,
    OLDER_SHEET_EXCLUDE,
    PHOTO_FAMILIES,
    PHOTO_FOLDER,
    PHOTO_LETTERS,
    SHEET_MANIFEST,
    SHEET_ORDER_SHEET,
)

DEPLOYMENT_ID_COLUMNS = ["KnollID", "SiteID", "Spot"]


def deployment_lists(df: DataFrame, by: Sequence[str], dep: str | Column,
                     order: str = "row_idx", name: str = "deployments") -> DataFrame:
    """G1: per group, the deployment ids in row order, missing ids kept.

    A group is one day's plan for one observer pair, so a list holds that
    pair's dives of the day. Pairs are kept as structs so nulls survive.
    """
    d = F.col(dep) if isinstance(dep, str) else dep
    return (df.groupBy(*[F.col(f"`{c}`") for c in by])
            .agg(F.array_sort(F.collect_list(F.struct(F.col(f"`{order}`").alias("o"),
                                                      d.cast("string").alias("d"))))
                 .alias("__deps"))
            .withColumn(name, F.transform("__deps", lambda x: x["d"])).drop("__deps"))


def with_emails(df: DataFrame, emails: DataFrame, observers: Sequence[str],
                name_col: str = "FullName", email_col: str = "email") -> DataFrame:
    """J1 + G2: one left lookup per observer column (missing name matches a
    missing name), then ``emails`` = the looked-up addresses in order."""
    lookup = broadcast_if_small(emails.select(name_col, email_col))
    out = df
    for i, obs in enumerate(observers, start=1):
        lk = lookup.select(F.col(name_col).alias(obs), F.col(email_col).alias(f"email_{i}"))
        out = null_safe_join(out, lk, [obs], "left")
    return (out.withColumn("emails", F.array(*[F.col(f"email_{i}") for i in range(1, len(observers) + 1)]))
            .drop(*[f"email_{i}" for i in range(1, len(observers) + 1)]))


def _observer_columns(meta: DataFrame, family: str) -> DataFrame:
    """Juvenile observers and the location take part only for the juvenile
    families (null elsewhere); ``__juv`` marks those rows."""
    m = meta
    for c in [*JUVENILE_OBSERVER_COLUMNS, "Location"]:
        if c not in m.columns:
            m = m.withColumn(c, F.lit(None).cast("string"))
    juv = F.coalesce(F.col(family).isin(list(JUVENILE_FAMILIES)), F.lit(False))
    m = m.withColumn("__juv", juv).select(
        "*", *[F.when(F.col("__juv"), F.col(f"`{c}`")).alias(f"__{c}")
               for c in ["Location", *JUVENILE_OBSERVER_COLUMNS]])
    return m.drop("Location", *JUVENILE_OBSERVER_COLUMNS).withColumnsRenamed(
        {f"__{c}": c for c in ["Location", *JUVENILE_OBSERVER_COLUMNS]})


def _surveyor_group(by: Sequence[str], family: str) -> list[str]:
    return [*by, "Project", family, "__juv", *OBSERVER_COLUMNS, "Location", *JUVENILE_OBSERVER_COLUMNS]


def _with_label_and_emails(df: DataFrame, emails: DataFrame) -> DataFrame:
    pair = F.concat(na_text("First Observer"), F.lit(" and "), na_text("Second Observer"))
    quartet = F.concat(na_text("First Observer"), F.lit(", "), na_text("Second Observer"), F.lit(", "),
                       na_text("Juveniles First Observer"), F.lit(", and "),
                       na_text("Juveniles Second Observer"))
    out = df.withColumn("spreadsheet_name", F.when(F.col("__juv"), quartet).otherwise(pair))
    lookup = broadcast_if_small(emails.select("FullName", "email"))
    for i, obs in enumerate([*OBSERVER_COLUMNS, *JUVENILE_OBSERVER_COLUMNS], start=1):
        lk = lookup.select(F.col("FullName").alias(obs), F.col("email").alias(f"email_{i}"))
        if i <= 2:
            out = null_safe_join(out, lk, [obs], "left")
        else:
            out = conditional_left_join(out, lk.withColumn("__juv", F.lit(True)), [obs], "__juv", True)
    emails_arr = F.when(F.col("__juv"), F.array(*[F.col(f"email_{i}") for i in range(1, 5)])).otherwise(
        F.array("email_1", "email_2"))
    return out.withColumn("emails", emails_arr).drop("__juv", *[f"email_{i}" for i in range(1, 5)])


def _deployment_id(m: DataFrame) -> Column:
    ids = [F.col(c) for c in DEPLOYMENT_ID_COLUMNS if c in m.columns]
    return (F.coalesce(*ids) if ids else F.lit(None).cast("string")).cast("string")


def surveyor_tables(meta: DataFrame, emails: DataFrame, by: Sequence[str] = ("file",),
                    family: str = "family") -> DataFrame:
    """G1 + J1 + G2 for every family in one pass: one row per observer pair
    (quartet for the juvenile families, with the location) and plan, with
    the list of its deployments in plan order, its sheet name and emails.
    The juvenile lookups are applied to juvenile rows only."""
    m = _observer_columns(meta, family)
    lists = deployment_lists(m, _surveyor_group(by, family), _deployment_id(m))
    return _with_label_and_emails(lists, emails)


def surveyor_rows(meta: DataFrame, emails: DataFrame, by: Sequence[str] = ("file",),
                  family: str = "family") -> DataFrame:
    """Long form of the surveyor table: one row per planned deployment with
    its pair's sheet name and emails and its position in the pair's list
    (``dep_order``). No list is built, so the manifests below never hold a
    pair's deployments in one row."""
    m = _observer_columns(meta, family)
    group = _surveyor_group(by, family)
    long = m.select(*[F.col(f"`{c}`") for c in group], _deployment_id(m).alias("deployment"), "row_idx")
    long = number_rows(long, group, "row_idx", "dep_order").drop("row_idx")
    return _with_label_and_emails(long.withColumn("dep_order", F.col("dep_order").cast("int")), emails)


def distinct_emails(surveyors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every address of a plan once (a missing address is one value).
    Takes the surveyor table or its long form."""
    return surveyors.select(*by, F.explode("emails").alias("email")).distinct()


def _one_row_per_surveyor(surveyors: DataFrame) -> DataFrame:
    # the long form has one row per deployment; its first one stands for the pair
    return surveyors.filter(F.col("dep_order") == 0) if "dep_order" in surveyors.columns else surveyors


def access_list(surveyors: DataFrame, by: Sequence[str] = (), family: str = "family") -> DataFrame:
    """Writer rows (spreadsheet, email) per surveyor, duplicates kept, the
    same for the pair's photo folder in the families that take photos, and
    reader rows (the plan's metadata) per distinct email; a missing email is
    reported instead of granted. Takes the surveyor table or its long form."""
    surveyors = _one_row_per_surveyor(surveyors)
    targets = F.array(F.col("spreadsheet_name"))
    if family in surveyors.columns:
        photos = F.concat(F.lit(PHOTO_FOLDER + "/"), F.col("spreadsheet_name"))
        targets = F.when(F.col(family).isin(list(PHOTO_FAMILIES)), F.array("spreadsheet_name", photos)).otherwise(targets)
    writers = surveyors.select(*by, F.explode(targets).alias("spreadsheet_name"), "emails").select(
        *by, "spreadsheet_name", F.explode("emails").alias("email"), F.lit("writer").alias("role"))
    readers = distinct_emails(surveyors, by).select(
        *by, F.lit("metadata").alias("spreadsheet_name"), "email", F.lit("reader").alias("role"))
    both = writers.unionByName(readers)
    return both.withColumn("status", F.when(F.col("email").isNull(), F.lit("missing email"))
                           .otherwise(F.lit("grant")))


def _manifest_rows() -> list[tuple]:
    rows = []
    for fam, (letters, layers, pattern, prefill) in SHEET_MANIFEST.items():
        n = 0
        for letter in letters:
            for layer in layers:
                prefix = "Juveniles - " if (layer == "Juveniles" and "{layer_prefix}" in pattern) else ""
                name = pattern.replace("{layer_prefix}", prefix).replace("{layer}", layer or "")
                rows.append((fam, n, letter, layer, name, prefill))
                n += 1
    return rows


def sheet_dimension(spark) -> DataFrame:
    """(family, sheet_order, letter, layer, name pattern, prefill fields): the
    literal dimension of expected sheets (a few dozen rows)."""
    return spark.createDataFrame(
        _manifest_rows(),
        "family string, sheet_order int, letter string, layer string, pattern string, prefill array<string>")


def _deployment_rows(surveyors: DataFrame) -> DataFrame:
    """One row per (pair, deployment) from the long form, or from the lists."""
    if "dep_order" in surveyors.columns:
        return surveyors
    return surveyors.select("*", F.posexplode("deployments").alias("dep_order", "deployment"))


def worksheet_manifest(surveyors: DataFrame, by: Sequence[str] = (), family: str = "family") -> DataFrame:
    """Every sheet the pairs should fill, with its prefilled values.
    Takes the long form (``surveyor_rows``) or the surveyor table."""
    rows = _deployment_rows(surveyors)
    deps = rows.select(*by, family, "spreadsheet_name", "Project", *OBSERVER_COLUMNS,
                       *[c for c in [*JUVENILE_OBSERVER_COLUMNS, "Location"] if c in rows.columns],
                       "dep_order", "deployment")
    for c in [*JUVENILE_OBSERVER_COLUMNS, "Location"]:
        if c not in deps.columns:
            deps = deps.withColumn(c, F.lit(None).cast("string"))
    dim = F.broadcast(sheet_dimension(surveyors.sparkSession))
    j = deps.join(dim, family, "inner")
    # the deployment last: its text may hold anything
    sheet = F.replace(F.replace("pattern", F.lit("{letter}"), F.coalesce(F.col("letter"), F.lit(""))),
                      F.lit("{dep}"), na_text("deployment"))
    fields = {
        "first": na_text("First Observer"), "second": na_text("Second Observer"),
        "jfirst": na_text("Juveniles First Observer"), "jsecond": na_text("Juveniles Second Observer"),
        "location": na_text("Location"), "dep": na_text("deployment"), "letter": na_text("letter"),
    }
    prefill = F.transform("prefill", lambda p: _field_value(p, fields))
    return j.select(*by, family, "Project", "spreadsheet_name", "dep_order", "deployment",
                    "sheet_order", "letter", "layer", sheet.alias("sheet"), prefill.alias("prefill"))


def _field_value(p: Column, fields: dict[str, Column]) -> Column:
    expr = F.when(p.startswith("="), F.ltrim(p, F.lit("=")))
    for name, value in fields.items():
        expr = expr.when(p == name, value)
    return expr


def photo_manifest(surveyors: DataFrame, by: Sequence[str] = (), family: str = "family") -> DataFrame:
    """R2: photo folders pair / deployment / letter for families that take photos."""
    deps = (_deployment_rows(surveyors).filter(F.col(family).isin(list(PHOTO_FAMILIES)))
            .select(*by, "spreadsheet_name", "deployment"))
    out = deps.select(*by, "spreadsheet_name", "deployment",
                      F.explode(F.array(*[F.lit(x) for x in PHOTO_LETTERS])).alias("letter"))
    return out.withColumn("folder", F.concat_ws("/", "spreadsheet_name", na_text("deployment"), "letter"))


def arrived_sheets(grid: DataFrame, keys: Sequence[str], ignore: str = OLDER_SHEET_EXCLUDE) -> DataFrame:
    """``(keys, arrived, filled_rows)`` of the sheets that came in: how often
    (headers), and data rows with any cell past the metadata block. The lists
    and notes that every spreadsheet holds are not counted."""
    some = F.exists(F.slice("cells", 3, F.greatest(F.size("cells"), F.lit(1))), lambda x: x.isNotNull())
    g = grid.filter(~F.col("sheet").rlike(ignore) & (F.col("sheet") != SHEET_ORDER_SHEET))
    return g.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count_if(F.col("row_idx") == 0).alias("arrived"),
        F.count_if((F.col("row_idx") >= 1) & some).alias("filled_rows"))


def reconcile_sheets(manifest: DataFrame, grid: DataFrame, by: Sequence[str] = ("expedition", "day_folder")) -> DataFrame:
    """Expected against arrived sheets: ``(by, spreadsheet, sheet, expected,
    arrived, filled_rows, status)``, a row per sheet of either side. Status:
    ``missing`` (expected, not arrived), ``unexpected``, ``duplicate`` (arrived
    more than once, or expected more than once under one name), ``empty``
    (arrived once without an observation) or ``ok``.

    Both sides are reduced to one row per sheet before they meet in one
    aggregate, so a sheet of any size and a day of any number of sheets cost
    one row each.
    """
    keys = [*by, "spreadsheet", "sheet"]
    expected = manifest.withColumnRenamed("spreadsheet_name", "spreadsheet") \
        .groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("expected"))
    both = expected.unionByName(arrived_sheets(grid, keys), allowMissingColumns=True)
    counts = both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("expected", "arrived", "filled_rows")])
    status = (F.when(F.col("arrived") == 0, "missing").when(F.col("expected") == 0, "unexpected")
              .when((F.col("arrived") > 1) | (F.col("expected") > 1), "duplicate")
              .when(F.col("filled_rows") == 0, "empty").otherwise("ok"))
    return counts.withColumn("status", status)

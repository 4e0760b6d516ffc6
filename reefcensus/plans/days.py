"""Collection side, set at once: worksheet grid of every expedition and day
-> observation rows with their sheet metadata -> deployment key -> checks
-> day tables -> expedition table; and the Tel Aviv fish / invertebrate
analysis tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefcensus.functions.labels import group_flag, layer_letter
from reefcensus.operators.checks import before_cutoff, fail_on
from reefcensus.operators.complete import (
    DAY_KEYS,
    DEPLOYMENT_KEY,
    complete_days,
    day_complete,
    day_families,
    days_to_build,
    join_days,
    sample_key,
    skip_complete,
    unmatched_deployments,
)
from reefcensus.operators.cover import invertebrate_sheets
from reefcensus.operators.grid import (
    SHEET_KEYS,
    duplicate_metadata_keys,
    metadata_pairs,
    metadata_columns,
    metadata_map,
    odd_observer_widths,
    observer_rows,
    recycle_metadata,
    sheet_offsets,
)
from reefcensus.operators.clean import fill_down
from reefcensus.operators.joins import broadcast_if_small, conditional_left_join
from reefcensus.operators.surveyors import reconcile_sheets, surveyor_rows, worksheet_manifest
from reefcensus.operators.traits import format_fish, format_invertebrates, tag_group
from reefcensus.registry import (
    FISH_LAYOUT,
    FISH_SHEET_EXCLUDE,
    INVERT_LAYOUT,
    INVERTEBRATE_SHEET_EXCLUDE,
    LAYER_LETTER_FAMILIES,
    OBSERVATION_REQUIRED,
    OLDER_FILL_COLUMNS,
    OLDER_QUADRAT_SHEET,
    OLDER_SHEET_EXCLUDE,
    OLDER_TLV_OBSERVATION_REQUIRED,
    TLV_LAYOUT_CUTOFF,
    TLV_METADATA_KEYS,
    TLV_OBSERVATION_REQUIRED,
)
from reefcensus.session import cut_lineage, stored_once
from reefcensus.sinks import write_backup, write_day_complete, write_expedition
from reefcensus.sources.lookups import (
    prune_day_folders,
    prune_sheets,
    prune_sources,
    read_complete_days,
    read_group_days,
)
from reefcensus.sources.worksheets import read_grid, read_worksheet_csvs, write_grid

# Sheet metadata keys that become columns (first value per key).
WORKSHEET_METADATA_KEYS = [
    "First Observer", "Second Observer", "Juveniles First Observer",
    "Juveniles Second Observer", "Site", "Knoll", "Transect", "Sampling Type", "Location",
    *[k for k in TLV_METADATA_KEYS if k not in ("Site", "Transect")],
]

# Observation fields projected out of the sheet rows (others stay in ``obs``).
OBSERVATION_FIELDS = ["Observer", "Species", "Amount", "Length", "Distance", "Confidence",
                      *[str(i) for i in range(1, 26)]]


def _with_day_family(grid: DataFrame, meta: DataFrame) -> DataFrame:
    fams = broadcast_if_small(day_families(meta))
    return grid.join(fams, DAY_KEYS, "inner")


def day_sheets(grid: DataFrame, meta: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """The observation sheets (fish / general) of the planned days, with the
    day's family."""
    g = prune_sheets(prune_sources(prune_day_folders(grid), names=sources), exclude=FISH_SHEET_EXCLUDE)
    return _with_day_family(g, meta)


def sample_rows(grid: DataFrame, meta: DataFrame, keys: Sequence[str] = SHEET_KEYS,
                sources: Sequence[str] | None = None) -> DataFrame:
    """Observation rows with their sheet metadata and deployment key, for
    every day at once (fish / general sheets)."""
    return _sample_rows(day_sheets(grid, meta, sources), keys)


def _sample_rows(g: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """``sample_rows`` of ``day_sheets``."""
    # the family is constant per day, so it rides along as a group key
    by = [*keys, "family"]
    sheet_meta = metadata_columns(metadata_map(metadata_pairs(g, by), by), by, WORKSHEET_METADATA_KEYS)
    sheet_meta = sheet_meta.withColumn(
        "Letter", F.when(F.col("family").isin(list(LAYER_LETTER_FAMILIES)), layer_letter("sheet")))
    tlv = g.filter(F.col("family") == "Tel Aviv Transects").drop("family")
    other = g.filter(F.col("family") != "Tel Aviv Transects").drop("family")
    obs = observer_rows(other, keys, paired=True, required=OBSERVATION_REQUIRED).unionByName(
        observer_rows(tlv, keys, paired=False, required=TLV_OBSERVATION_REQUIRED))
    obs = obs.select(*keys, "row_idx", "observer_half", "obs", "obs_cells",
                     *[F.try_element_at("obs", F.lit(n)).alias(n) for n in OBSERVATION_FIELDS])
    rows = recycle_metadata(sheet_meta, obs, keys)
    return sample_key(rows)


def day_tables(meta: DataFrame, samples: DataFrame, strict: bool = False, materialize: bool = True,
               held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(day complete data, mismatches). A day with a planned deployment that
    has no observation is reported and left out, as the protocol aborts it;
    ``strict`` stops the whole run instead (one bounded probe). Days of
    ``held`` (``held_sheets``) are reported and left out the same way.

    The observation rows feed three branches (mismatch check, matched rows,
    unmatched plans); ``materialize`` writes them once to the shared
    checkpoint folder, so the sheets are read and reshaped once and the
    checks read the key columns alone.
    """
    if materialize:
        samples = stored_once(samples, "samples")
    bad = unmatched_deployments(meta, samples)
    if held is not None:
        bad = bad.unionByName(held)
    if strict:
        fail_on(bad, "mismatching identifiers")
    complete = day_complete(meta, samples)
    bad_days = broadcast_if_small(bad.select(*DAY_KEYS).distinct())
    return complete.join(bad_days, DAY_KEYS, "left_anti"), bad


def build_days(meta: DataFrame, grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``day_tables`` of all planned days. The grid is scanned once: the
    sheets of these days are stored, and the observation rows and the sheet
    checks read them there."""
    sheets = stored_once(day_sheets(grid, meta), "sheets")
    return day_tables(meta, _sample_rows(sheets), held=_held(_sheet_violations(sheets)))


def expedition_table(meta: DataFrame, grid: DataFrame, stored: DataFrame | None = None
                     ) -> tuple[DataFrame, DataFrame]:
    """Rebuild only the days without a stored table, stack the stored
    ones. Returns (expedition table, mismatches of the rebuilt days)."""
    todo_meta = meta if stored is None else days_to_build(meta, stored)
    todo_grid = grid if stored is None else days_to_build(grid, stored)
    built, bad = build_days(todo_meta, todo_grid)
    if stored is None:
        return built, bad
    return skip_complete(built, stored), bad


def tlv_fish(meta: DataFrame, grid: DataFrame, traits: DataFrame, carry: Sequence[str] = ()
             ) -> tuple[DataFrame, DataFrame]:
    """Fish analysis table (57 columns, behind the ``carry`` columns) and
    cutoff violations."""
    tlv_meta = meta.filter(F.col("family") == "Tel Aviv Transects")
    early = before_cutoff(tlv_meta, "Date", TLV_LAYOUT_CUTOFF, DAY_KEYS)
    ok_meta = tlv_meta.join(broadcast_if_small(early.select(*DAY_KEYS).distinct()), DAY_KEYS, "left_anti")
    samples = tag_group(sample_rows(grid, ok_meta), "Fish")
    joined = day_complete(ok_meta, samples)
    return format_fish(joined, traits, carry), early


def tlv_invertebrates(meta: DataFrame, grid: DataFrame, keys: Sequence[str] = SHEET_KEYS,
                      carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Invertebrate analysis table (60 columns, behind the ``carry`` columns)
    and cutoff violations."""
    tlv_meta = meta.filter(F.col("family") == "Tel Aviv Transects")
    early = before_cutoff(tlv_meta, "Date", TLV_LAYOUT_CUTOFF, DAY_KEYS)
    ok_meta = tlv_meta.join(broadcast_if_small(early.select(*DAY_KEYS).distinct()), DAY_KEYS, "left_anti")
    g = prune_sheets(prune_sources(prune_day_folders(grid)), exclude=INVERTEBRATE_SHEET_EXCLUDE)
    g = _with_day_family(g, ok_meta)
    sheets = invertebrate_sheets(g, [*keys, "family"], TLV_METADATA_KEYS)
    samples = sample_key(tag_group(sheets, "Invertebrates"))
    joined = day_complete(ok_meta, samples)
    return format_invertebrates(joined, carry), early


def build_tlv(spark, meta: DataFrame, grid: DataFrame, traits: DataFrame, complete_path: str) -> DataFrame:
    """Tel Aviv days to their outputs (K1): one table per day and group
    (``expedition / day_folder / Group``), each in its own layout; building a
    day again replaces its groups alone. Returns the days before the layouts'
    cutoff, which are not built."""
    fish, early = tlv_fish(meta, grid, traits, carry=DAY_KEYS)
    write_day_complete(fish, complete_path, group=True)
    invertebrates, _ = tlv_invertebrates(meta, grid, carry=DAY_KEYS)
    write_day_complete(invertebrates, complete_path, group=True)
    return early


def read_tlv_group(spark, complete_path: str, group: str, expedition: str | None = None) -> DataFrame:
    """The stored Tel Aviv days of one group (``Fish`` or ``Invertebrates``),
    in its layout behind the day keys."""
    layout = {"Fish": FISH_LAYOUT, "Invertebrates": INVERT_LAYOUT}[group]
    return read_group_days(spark, complete_path, group, layout, expedition)


def arrived_check(meta: DataFrame, grid: DataFrame) -> DataFrame:
    """R1 against what arrived: every sheet that the plans expect or that a
    planned day holds, with its status (``reconcile_sheets``)."""
    none = meta.sparkSession.createDataFrame([], "FullName string, email string")
    expected = worksheet_manifest(surveyor_rows(meta.filter(F.col("family").isNotNull()), none, DAY_KEYS), DAY_KEYS)
    g = prune_sources(prune_day_folders(grid))
    days = broadcast_if_small(meta.select(*DAY_KEYS).distinct())
    return reconcile_sheets(expected, g.join(days, DAY_KEYS, "left_semi"), DAY_KEYS)


def stored_days(stored: DataFrame) -> DataFrame:
    """I1."""
    return complete_days(stored)


def sheet_violations(grid: DataFrame, meta: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Sheets that cannot be read as the protocol expects: odd observer
    width on paired sheets (S19) and repeated metadata keys (S21)."""
    return _sheet_violations(day_sheets(grid, meta), keys)


def _sheet_violations(g: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """``sheet_violations`` of ``day_sheets``."""
    paired = g.filter(F.col("family") != "Tel Aviv Transects").drop("family")
    odd = odd_observer_widths(paired, keys).select(*keys, "check")
    dup = duplicate_metadata_keys(metadata_pairs(g.drop("family"), keys), keys).select(*keys, "check")
    return odd.unionByName(dup)


def held_sheets(grid: DataFrame, meta: DataFrame) -> DataFrame:
    """Sheet violations in the shape of mismatches: the day, the sheet in
    place of the deployment key, and the check it fails."""
    return _held(sheet_violations(grid, meta))


def _held(bad: DataFrame) -> DataFrame:
    return bad.select(*DAY_KEYS, F.concat_ws("/", "spreadsheet", "sheet").alias(DEPLOYMENT_KEY), "check")


def build_expedition(spark, meta: DataFrame, grid: DataFrame, complete_path: str, expedition_path: str,
                     backup_path: str | None = None, skip_complete: bool = True) -> DataFrame:
    """I2 to its outputs: days without a stored table (or all of them) are
    built and written (K1), then the stored days of those expeditions make
    the expedition table (K2) and its CSV backup (K3). Returns the
    mismatches, written to the shared folder first."""
    todo_meta, todo_grid = meta, grid
    if skip_complete and (stored := stored_table(spark, complete_path)) is not None:
        todo_meta, todo_grid = days_to_build(meta, stored), days_to_build(grid, stored)
    built, bad = build_days(todo_meta, todo_grid)
    bad = cut_lineage(bad)
    write_day_complete(built, complete_path)
    stored = read_complete_days(spark, complete_path)
    wanted = meta.select("expedition").distinct()
    publish_expeditions(stored.join(wanted, "expedition", "left_semi"), expedition_path, backup_path)
    return bad


def join_expedition(spark, complete_path: str, expedition_path: str, expedition: str,
                    backup_path: str | None = None) -> None:
    """I3 to its outputs: the stored days of one expedition (K2, K3)."""
    publish_expeditions(join_days(read_complete_days(spark, complete_path), expedition), expedition_path, backup_path)


def publish_expeditions(days: DataFrame, expedition_path: str, backup_path: str | None) -> None:
    """K2 and K3."""
    write_expedition(days, expedition_path)
    if backup_path is not None:
        write_backup(days, backup_path, "expeditions")


def stored_table(spark, path: str) -> DataFrame | None:
    """The stored days, or nothing before the first build."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return read_complete_days(spark, path)


OLDER_OBS_FIELDS = ["Species", "Amount", "Length", "Distance", "Confidence", "Invertebrate|Taxon",
                    "Abundance", "Quadrate"]


def older_tlv_rows(grid: DataFrame, meta: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Older Tel Aviv layout: the group comes from the sheet name (P16);
    ``Quadrate data`` sheets hold quadrat rows with blanks read as ``0``
    (P18), joined onto invertebrate rows on observers, site, transect and
    quadrat within the spreadsheet (J9); times and depths fill down per
    (Site, Transect) within a spreadsheet in the order of its tabs (P4)."""
    g = _with_day_family(prune_sources(grid), meta)
    g = g.filter(F.col("family") == "Tel Aviv Transects").drop("family")
    obs_sheets = prune_sheets(g, exclude=OLDER_SHEET_EXCLUDE)
    quad_sheets = prune_sheets(g, include=OLDER_QUADRAT_SHEET)
    sheet_meta = metadata_columns(metadata_map(metadata_pairs(obs_sheets, keys), keys), keys, WORKSHEET_METADATA_KEYS)
    sheet_meta = sheet_meta.withColumn("Group", group_flag("sheet"))
    obs = observer_rows(obs_sheets, keys, paired=False, required=OLDER_TLV_OBSERVATION_REQUIRED)
    obs = obs.select(*keys, "row_idx", "obs", *[F.try_element_at("obs", F.lit(n)).alias(n) for n in OLDER_OBS_FIELDS])
    rows = recycle_metadata(sheet_meta, obs, keys)

    spreadsheet = [k for k in keys if k != "sheet"]
    join_keys = ["Fish Observer", "Invertebrate Observer", "Site", "Transect", "Quadrate"]
    qmeta = metadata_columns(metadata_map(metadata_pairs(quad_sheets, keys), keys), keys, join_keys[:4]) \
        .withColumnRenamed("metadata", "quadrat_metadata")
    qrows = observer_rows(quad_sheets, keys, paired=False, required=())
    qrows = (qrows.withColumn("Quadrate", F.try_element_at("obs", F.lit("Quadrate")))
             .filter(F.col("Quadrate").isNotNull())
             .select(*keys, "Quadrate",
                     F.transform_values("obs", lambda k, v: F.coalesce(v, F.lit("0"))).alias("quadrat_data")))
    quads = recycle_metadata(qmeta, qrows, keys).drop("sheet")
    joined = conditional_left_join(rows, quads, [*spreadsheet, *join_keys], "Group", "Invertebrates")

    # tab order inside a spreadsheet, then row order: one dense position
    offsets = sheet_offsets(g, keys).select(*keys, "offset")
    joined = joined.join(broadcast_if_small(offsets), list(keys)).withColumn("__pos", F.col("offset") + F.col("row_idx"))
    filled = fill_down(joined, [*spreadsheet, "Site", "Transect"], "__pos", OLDER_FILL_COLUMNS)
    return sample_key(filled.withColumn("family", F.lit("Tel Aviv Transects"))).drop("__pos", "offset")


def ingest_worksheets(spark, sheets_root: str, grid_path: str) -> DataFrame:
    """One-time ingest: every worksheet CSV under ``sheets_root`` into the
    parquet grid (partitioned by expedition and day; rewriting a day
    replaces only that day). Returns the grid as stored."""
    write_grid(read_worksheet_csvs(spark, sheets_root), grid_path)
    return read_grid(spark, grid_path)

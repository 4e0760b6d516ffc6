"""Worksheet-grid operators.

A worksheet grid holds every sheet of every expedition at once:
``(sheet keys..., row_idx INT, cells ARRAY<STRING>)``, row 0 = header.
Cells are addressed 1-based (``cell(grid, 4)`` = sheet column D).

P6 key/value block, P7 canonical values, P13 side-by-side observer split
(with A3 header repair), P14 metadata recycling, order of sheets, Q1-Q5 fixed
blocks of the invertebrate sheet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefcensus.functions.text import canonical_text, strip_repair_suffix, with_canonical
from reefcensus.operators.clean import complete_obs
from reefcensus.registry import (
    INVERT_BLOCK_ROWS,
    INVERT_COMPLEXITY_COLS,
    INVERT_COMPLEXITY_ROWS,
    INVERT_COUNT_COLS,
    INVERT_COVER_COLS,
    INVERT_LEGEND_ROWS,
    INVERT_METADATA_ROWS,
    OBSERVATION_REQUIRED,
    SHEET_ORDER_SHEET,
)

SHEET_KEYS = ["expedition", "day_folder", "spreadsheet", "sheet"]


def cell(i: int, cells: str = "cells") -> Column:
    """1-based cell of a grid row; null past the end of the row."""
    return F.try_element_at(F.col(cells), F.lit(i))


# --------------------------------------------------------------------------
# Key/value metadata block
# --------------------------------------------------------------------------

def metadata_pairs(grid: DataFrame, keys: Sequence[str] = SHEET_KEYS,
                   rows: tuple[int, int] | None = None,
                   drop_blank_keys: bool = True) -> DataFrame:
    """Long ``(keys, row_idx, k, v)`` from sheet columns 1-2 of the data rows."""
    data = grid.filter(F.col("row_idx") >= 1)
    if rows is not None:
        data = data.filter(F.col("row_idx").between(rows[0], rows[1]))
    out = data.select(*keys, "row_idx", cell(1).alias("k"), cell(2).alias("v"))
    return out.filter(F.col("k").isNotNull()) if drop_blank_keys else out


def metadata_map(pairs: DataFrame, keys: Sequence[str], k: str = "k", v: str = "v",
                 order: str = "row_idx", canonical: bool = True) -> DataFrame:
    """One row per sheet with all its metadata keys in the map ``metadata``
    (first value in sheet order; canonical text unless that is off). A sheet
    holds few keys, so the map is bounded by the sheet."""
    if canonical:
        pairs = with_canonical(pairs, {v: F.col(f"`{v}`")})
    by = [F.col(f"`{c}`") for c in keys]
    first = pairs.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(order, k, v))).alias("__pairs"))
    names, values = F.col("__pairs")[k], F.col("__pairs")[v]
    # most sheets have each key once; only the others look for the first of each
    plain = F.size(F.array_distinct(F.array_compact(names))) == F.size(names)
    entries = F.filter("__pairs", lambda p, i: F.array_position(names, p[k]) == i + 1)
    return first.select(*by, F.when(plain, F.map_from_arrays(names, values)).otherwise(
        F.map_from_entries(F.transform(entries, lambda p: F.struct(p[k], p[v])))).alias("metadata"))


def metadata_columns(meta: DataFrame, keys: Sequence[str], known_keys: Sequence[str]) -> DataFrame:
    """The named keys as columns beside the whole ``metadata`` map."""
    return meta.select(*[F.col(f"`{c}`") for c in keys], "metadata",
                       *[F.try_element_at("metadata", F.lit(n)).alias(n) for n in known_keys])


def duplicate_metadata_keys(pairs: DataFrame, keys: Sequence[str], k: str = "k") -> DataFrame:
    """Violations: a metadata key that appears more than once in one sheet."""
    return (pairs.groupBy(*keys, k).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1).withColumn("check", F.lit("duplicate metadata key")))


# --------------------------------------------------------------------------
# Observation block
# --------------------------------------------------------------------------

def _header_width(h: DataFrame, keys: Sequence[str]) -> DataFrame:
    last_named = F.array_max(F.filter(
        F.transform("header", lambda x, i: F.when(x.isNotNull(), i + 1)),
        lambda p: p.isNotNull()))
    width = F.greatest(F.coalesce(last_named, F.lit(0)) - 2, F.lit(0))
    return h.select(*keys, "header", width.alias("obs_width"))


def _headers(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per sheet: header names of the observation columns (3..last named)."""
    h = grid.filter(F.col("row_idx") == 0).select(*keys, F.col("cells").alias("header"))
    return _header_width(h, keys)


def odd_observer_widths(grid: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Violations: paired sheets whose observation width is odd."""
    return (_headers(grid, keys).filter(F.col("obs_width") % 2 == 1)
            .select(*keys, "obs_width").withColumn("check", F.lit("odd observer columns")))


def _half_columns(names: Column) -> tuple[Column, Column]:
    """Of the names of one half: all its columns as ``(position, name)`` in
    order (a blank heading has no name), and those that are the first of
    their name."""
    named = F.transform(names, lambda x: F.nullif(F.coalesce(x, F.lit("")), F.lit("")))
    columns = F.transform(named, lambda x, i: F.named_struct(F.lit("position"), i + 1, F.lit("name"), x))
    first = F.filter(columns, lambda c: c["name"].isNotNull() & (F.array_position(named, c["name"]) == c["position"]))
    return columns, first


def _known_header(header: Sequence[str | None], paired: bool) -> tuple[list[str | None], int]:
    """Python twin of the per-sheet header rule for a known header: the names
    of one half, and the width of the observation columns."""
    last = max((i for i, h in enumerate(header, start=1) if h is not None), default=0)
    width = max(last - 2, 0)
    half = header[2:2 + (width // 2 if paired else width)]
    return [h and h.split("...")[0] for h in half], width


def observer_rows(grid: DataFrame, keys: Sequence[str] = SHEET_KEYS, paired: bool = True,
                  required: Sequence[str] = OBSERVATION_REQUIRED,
                  header: Sequence[str | None] | None = None) -> DataFrame:
    """Observation rows of every sheet: ``(keys, row_idx, observer_half,
    obs_names, obs, obs_cells)``.

    Paired sheets hold two observers side by side: the right half is stacked
    under the left half's names (``observer_half`` 1 / 2); names lose the
    ``...N`` repair suffix. ``obs_cells`` has every cell of the half as
    ``(position, name, value)`` in sheet order, also those under a blank
    heading (null name) or a repeated one; ``obs`` maps each name to the cell
    of its first heading. Odd widths are skipped (see odd_observer_widths),
    as are sheets without a named column. Rows missing any required column
    the sheet has are dropped.

    Header work happens once per sheet (before the join to its rows); when
    every sheet shares a known ``header`` it is a literal and rows need no
    join.
    """
    data = grid.filter(F.col("row_idx") >= 1)
    halves = [1, 2] if paired else [1]
    if header is not None:
        rows = _rows_of_known_header(data, keys, header, paired, halves)
    else:
        heads = _headers(grid, keys)
        if paired:
            heads = heads.filter(F.col("obs_width") % 2 == 0)
        span = (F.col("obs_width") / 2).cast("int") if paired else F.col("obs_width")
        names = F.transform(F.slice("header", F.lit(3), span), strip_repair_suffix)
        columns, first = _half_columns(names)
        heads = heads.select(*keys, span.alias("__span"), columns.alias("__columns"), first.alias("__first"))
        heads = heads.filter(F.size("__first") > 0)
        rows = data.join(heads, list(keys), "inner").select(
            *keys, "row_idx", "cells", "__span", "__columns", "__first", F.explode(F.array(*map(F.lit, halves)))
            .alias("observer_half"))

        def value(c: Column) -> Column:
            return F.try_element_at("cells", 2 + (F.col("observer_half") - 1) * F.col("__span") + c["position"])

        obs_names = F.transform("__first", lambda c: c["name"])
        rows = rows.select(
            *keys, "row_idx", "observer_half", obs_names.alias("obs_names"),
            F.map_from_arrays(obs_names, F.transform("__first", value)).alias("obs"),
            F.transform("__columns", lambda c: F.named_struct(
                F.lit("position"), c["position"], F.lit("name"), c["name"], F.lit("value"), value(c))).alias("obs_cells"))
    return complete_obs(rows, required)


def _rows_of_known_header(data: DataFrame, keys: Sequence[str], header: Sequence[str | None], paired: bool,
                          halves: Sequence[int]) -> DataFrame:
    """``observer_rows`` of sheets that share a header: its names and places
    are literals, so rows need no join and no lambda."""
    names, width = _known_header(header, paired)
    if paired and width % 2:
        names = []
    named = {}
    for i, n in enumerate(names):
        if n:
            named.setdefault(n, i)
    obs_names = F.array(*[F.lit(n) for n in named]).cast("array<string>")
    # the map is built once, in the generator; the cells only where they are used
    parts = [F.struct(F.lit(h).alias("observer_half"), F.map_from_arrays(obs_names, F.array(*[
        F.try_element_at("cells", F.lit(3 + (h - 1) * len(names) + i)) for i in named.values()
    ]).cast("array<string>")).alias("obs")) for h in halves]
    rows = data.select(*keys, "row_idx", "cells", F.inline(F.array(*parts)))
    if not named:
        rows = rows.filter(F.lit(False))

    def value(i: int) -> Column:
        return F.get("cells", 2 + (F.col("observer_half") - 1) * len(names) + i)

    return rows.select(
        *keys, "row_idx", "observer_half", obs_names.alias("obs_names"), "obs",
        F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(n or None).cast("string").alias("name"),
                           value(i).alias("value")) for i, n in enumerate(names)])
        .cast("array<struct<position:int,name:string,value:string>>").alias("obs_cells"))


def obs_columns(obs_rows: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project named observation fields out of the map (missing -> null)."""
    return obs_rows.select(*[F.col(f"`{c}`") for c in keep],
                           *[F.try_element_at("obs", F.lit(n)).alias(n) for n in names])


def recycle_metadata(meta: DataFrame, obs: DataFrame, keys: Sequence[str] = SHEET_KEYS) -> DataFrame:
    """Repeat each sheet's metadata row on each of its observation rows; a
    sheet with no observations yields no rows (inner join)."""
    return meta.join(obs, list(keys), "inner")


# --------------------------------------------------------------------------
# Order of sheets and rows within a spreadsheet
# --------------------------------------------------------------------------

def sheet_offsets(grid: DataFrame, keys: Sequence[str] = SHEET_KEYS, sheet: str = "sheet") -> DataFrame:
    """``(keys, sheet_no, offset)`` of every sheet: its place among the tabs
    of its spreadsheet, and the rows of the sheets before it. ``offset +
    row_idx`` is a dense position of a row in its spreadsheet.

    The order is the one that the spreadsheet's ``sheet order`` sheet lists
    (a name a row, in column 1); sheets that it does not name come after
    those, by name. The prefix sums run over one row per sheet.
    """
    spreadsheet = [k for k in keys if k != sheet]
    listed = grid.filter((F.col(sheet) == SHEET_ORDER_SHEET) & (F.col("row_idx") >= 1)) \
        .filter(cell(1).isNotNull()).groupBy(*spreadsheet, cell(1).alias(sheet)).agg(F.min("row_idx").alias("listed"))
    sheets = grid.filter(F.col(sheet) != SHEET_ORDER_SHEET).groupBy(*keys).agg(
        (F.max("row_idx") + 1).cast("long").alias("n_rows"))
    order = Window.partitionBy(*spreadsheet).orderBy(F.asc_nulls_last("listed"), sheet)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return sheets.join(listed, [*spreadsheet, sheet], "left").select(
        *keys, (F.row_number().over(order) - 1).alias("sheet_no"),
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("offset"))


# --------------------------------------------------------------------------
# Invertebrate sheet blocks (Q1-Q5)
# --------------------------------------------------------------------------

def sheet_arrays(grid: DataFrame, keys: Sequence[str], last: int = INVERT_LEGEND_ROWS[1]) -> DataFrame:
    """One row per sheet: ``rows``, an array of the cells of its data rows
    ``1..last``; a row that the sheet does not have is null (a fixed block
    always has its rows). One aggregate of bounded size; every block below is
    an expression on it."""
    kept = F.when(F.col("row_idx").between(1, last), F.struct("row_idx", "cells"))
    sheets = grid.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.collect_list(kept).alias("__rows"))
    # the first of rows with one number, as a repeated sheet has them
    rows = F.transform(F.sequence(F.lit(1), F.lit(last)), lambda i: F.try_element_at(F.array_sort(F.transform(
        F.filter("__rows", lambda r: r["row_idx"] == i), lambda r: r["cells"])), F.lit(1)))
    return sheets.select(*[F.col(f"`{c}`") for c in keys], rows.alias("rows"))


def _rows(first: int, last: int) -> Column:
    return F.slice("rows", first, last - first + 1)


def _at(row: Column, i: int) -> Column:
    return F.try_element_at(row, F.lit(i))


def invert_metadata(sheets: DataFrame, keys: Sequence[str], known_keys: Sequence[str]) -> DataFrame:
    """Q1: rows 1-14, columns 1-2: all keys (first value of each, canonical
    text) in the map ``metadata``, the known ones as columns too. A sheet
    without any of these rows has no metadata and no row."""
    block = _rows(*INVERT_METADATA_ROWS)
    pairs = F.transform(block, lambda r: F.named_struct(F.lit("k"), _at(r, 1), F.lit("v"), canonical_text(_at(r, 2))))
    out = sheets.filter(F.exists(block, lambda r: r.isNotNull())).withColumn("__pairs", pairs)
    names = F.transform("__pairs", lambda p: p["k"])
    entries = F.filter("__pairs", lambda p, i: F.array_position(names, p["k"]) == i + 1)
    out = out.select(*sheets.columns, F.map_from_entries(entries).alias("metadata"))
    return out.select(*out.columns, *[F.try_element_at("metadata", F.lit(n)).alias(n) for n in known_keys])


def _legend() -> Column:
    lo, hi = INVERT_LEGEND_ROWS
    return F.transform(_rows(lo, hi), lambda r, i: F.named_struct(
        F.lit("row_idx"), i + lo, F.lit("Code"), _at(r, 1), F.lit("Value"), _at(r, 2)))


def legend(sheets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q2: rows 17-35, columns 1-2 as (Code, Value); absent rows give blank codes."""
    return sheets.select(*keys, F.inline(_legend()))


def _quadrat(block: int, side: int) -> Column:
    """One quadrat of a sheet's ``rows``."""
    (first, last), (point, species) = INVERT_BLOCK_ROWS[block], INVERT_COVER_COLS[side]
    taxon, count = INVERT_COUNT_COLS[side]
    complexity = _at(_at(F.col("rows"), INVERT_COMPLEXITY_ROWS[block]), INVERT_COMPLEXITY_COLS[side])
    points = F.transform(_rows(first, last), lambda r, i: F.named_struct(
        F.lit("row_idx"), i + first, F.lit("Point"), _at(r, point), F.lit("Code"), _at(r, point + 1),
        F.lit("Species"), _at(r, species)))
    counts = F.transform(_rows(first, last), lambda r: F.named_struct(
        F.lit("Taxon"), _at(r, taxon), F.lit("Count"), _at(r, count).try_cast("double")))
    return F.struct(
        F.lit(block * 2 + side + 1).alias("Quadrate"), complexity.try_cast("double").alias("Complexity"),
        points.alias("points"), F.filter(counts, lambda x: x["Taxon"].isNotNull()).alias("counts"))


def quadrat_arrays(sheets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Four rows per sheet: ``Quadrate``, ``Complexity`` (one cell), ``points``
    (array of row_idx, Point, Code, Species), ``counts`` (array of Taxon,
    Count; rows without a taxon left out, an unparseable count is null) and
    the sheet's ``legend``. Quadrate 1 = top-left, 2 = top-right, 3 =
    bottom-left, 4 = bottom-right."""
    quadrats = [_quadrat(block, side) for block in range(len(INVERT_BLOCK_ROWS)) for side in range(len(INVERT_COVER_COLS))]
    others = [c for c in sheets.columns if c not in (*keys, "rows")]
    return sheets.select(*keys, *others, _legend().alias("legend"), F.inline(F.array(*quadrats)))


def cover_points(sheets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q4: (Quadrate, Point, Code, Species) of the four cover rectangles with
    each quadrat's Complexity."""
    points = quadrat_arrays(sheets, keys).select(*keys, "Quadrate", "Complexity", F.inline("points"))
    return points.select(*keys, "row_idx", "Quadrate", "Complexity", "Point", "Code", "Species")


def quadrat_counts(sheets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q5: (Quadrate, Taxon, Count) of the four count rectangles."""
    return quadrat_arrays(sheets, keys).select(*keys, "Quadrate", F.inline("counts"))

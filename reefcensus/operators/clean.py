"""Cleaning operators for deployment tables and observation rows.

P1 heading renames, P2 default columns, P3/P4 forward fill, P11/P12 presence
filters, P18 zero fill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reefcensus.registry import DEFAULT_COUNTRY, HEADING_DROPS, HEADING_RENAMES

# Rows per fill-down chunk: bounds the rows one window task sorts for a key.
FILL_CHUNK_ROWS = 1 << 16


def normalise_headings(df: DataFrame, renames: dict[str, str] = HEADING_RENAMES,
                       drops: Sequence[str] = HEADING_DROPS) -> DataFrame:
    """Rename survey headings that exist (``Fish Observer`` -> ``First Observer``,
    ``Site`` -> ``SiteID`` ...) and drop the ``Dive`` column."""
    present = {old: new for old, new in renames.items() if old in df.columns}
    out = df.withColumnsRenamed(present) if present else df
    gone = [c for c in drops if c in out.columns]
    return out.drop(*gone) if gone else out


def add_defaults(df: DataFrame, project: str | None = None,
                 country: str = DEFAULT_COUNTRY) -> DataFrame:
    """Add ``Project`` (before ``Expedition``) and ``Country`` (first) when absent."""
    cols = list(df.columns)
    exprs: list[Column] = [F.col(f"`{c}`") for c in cols]
    if "Project" not in cols:
        proj = F.lit(project).cast("string").alias("Project")
        at = cols.index("Expedition") if "Expedition" in cols else len(cols)
        exprs.insert(at, proj)
        cols.insert(at, "Project")
    if "Country" not in cols:
        exprs.insert(0, F.lit(country).alias("Country"))
    return df.select(*exprs)


def fill_down(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str],
              chunk_rows: int = FILL_CHUNK_ROWS) -> DataFrame:
    """Blank cell = same as the row above, within ``by`` groups in ``order``.

    A two-level scan, so one hot group never lands in one task:

    1. rows are cut into chunks ``order // chunk_rows``;
    2. per chunk, its last non-null values (an aggregate that combines
       map-side: one small row per chunk);
    3. per chunk, the value carried in from earlier chunks (a window over
       that small table);
    4. the carried values enter each chunk as an extra first row, and one
       window per chunk fills the rest; the extra rows are dropped.

    The big side is shuffled once (by group and chunk) and never joined.
    ``order`` must be an integral, per-group unique, dense position
    (``row_idx`` in a file, an id).
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    by_cols = [F.col(f"`{b}`") for b in by]
    chunk, is_row = "__chunk", "__is_row"
    pos = F.col(f"`{order}`")
    base = (df.withColumn(chunk, F.floor(pos / F.lit(chunk_rows)).cast("long"))
            .withColumn(is_row, F.lit(1)))
    tails = base.groupBy(*by_cols, F.col(chunk)).agg(*[
        F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), pos)).alias(c) for c in cols])
    w_carry = (Window.partitionBy(*by_cols).orderBy(chunk)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = tails.select(*by_cols, F.col(chunk),
                         *[F.last(f"`{c}`", ignorenulls=True).over(w_carry).alias(c) for c in cols],
                         F.lit(0).alias(is_row))
    both = base.unionByName(carry, allowMissingColumns=True)
    w = (Window.partitionBy(*by_cols, F.col(chunk)).orderBy(F.col(is_row), pos)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = both.select(*[
        F.last(F.col(f"`{c}`"), ignorenulls=True).over(w).alias(c) if c in cols else F.col(f"`{c}`")
        for c in df.columns
    ], F.col(is_row))
    return filled.filter(F.col(is_row) == 1).drop(is_row)


def number_rows(df: DataFrame, by: Sequence[str], order: str, name: str,
                chunk_rows: int = FILL_CHUNK_ROWS) -> DataFrame:
    """``name``: the 0-based place of each row in its ``by`` group, in
    ``order`` (as in ``fill_down``). The rows of each chunk are counted, the
    counts of earlier chunks enter a chunk as an extra first row, and one
    window per chunk numbers the rest, so no task holds a hot group."""
    by_cols = [F.col(f"`{b}`") for b in by]
    chunk, is_row = "__chunk", "__is_row"
    base = df.withColumns({chunk: F.floor(F.col(f"`{order}`") / F.lit(chunk_rows)).cast("long"),
                           is_row: F.lit(1), name: F.lit(1).cast("long")})
    counts = base.groupBy(*by_cols, F.col(chunk)).agg(F.count(F.lit(1)).alias(name))
    earlier = Window.partitionBy(*by_cols).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(*by_cols, F.col(chunk), F.lit(0).alias(is_row),
                          F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name))
    w = (Window.partitionBy(*by_cols, F.col(chunk)).orderBy(F.col(is_row), F.col(f"`{order}`"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = base.unionByName(carry, allowMissingColumns=True).withColumn(name, F.sum(name).over(w) - 1)
    return both.filter(F.col(is_row) == 1).drop(chunk, is_row)


def fill_down_except(df: DataFrame, by: Sequence[str], order: str,
                     keep: Sequence[str], chunk_rows: int = FILL_CHUNK_ROWS) -> DataFrame:
    """Fill every column except ``keep`` (observers), the position and groups."""
    skip = set(keep) | set(by) | {order}
    return fill_down(df, by, order, [c for c in df.columns if c not in skip], chunk_rows)


def complete_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Keep rows where every required column that exists is present."""
    present = [c for c in required if c in df.columns]
    if not present:
        return df
    return df.filter(reduce(lambda a, b: a & b,
                            [F.col(f"`{c}`").isNotNull() for c in present]))


def complete_obs(df: DataFrame, required: Sequence[str], obs: str = "obs",
                 names: str = "obs_names") -> DataFrame:
    """Same rule as ``complete_rows`` for observations held in a map whose
    available keys are listed per row in ``names``."""
    conds = [(~F.array_contains(F.col(names), k)) | F.try_element_at(F.col(obs), F.lit(k)).isNotNull()
             for k in required]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where at least one of the named columns that exist is present."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df.limit(0)
    return df.filter(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in present]).isNotNull())


def zero_fill(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with no ``key``; then missing numbers -> 0 and text -> ``'0'``."""
    out = df.filter(F.col(f"`{key}`").isNotNull())
    targets = [c for c in (cols or out.columns) if c != key]
    types = dict((f.name, f.dataType) for f in out.schema.fields)
    exprs = []
    for c in out.columns:
        if c in targets:
            zero = F.lit("0") if isinstance(types[c], T.StringType) else F.lit(0).cast(types[c])
            exprs.append(F.coalesce(F.col(f"`{c}`"), zero).alias(c))
        else:
            exprs.append(F.col(f"`{c}`"))
    return out.select(*exprs)

"""Tel Aviv analysis columns: species traits and biomass, segment numbers,
seasons, ids, group tag and the two fixed output layouts.

J4 + P20 traits and weight, J5 segments, P19 season, P21 ids, P22 fish
layout, P23 invertebrate layout, P24 group tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reefcensus.functions.dates import parse_iso_date, season
from reefcensus.functions.labels import quadrat_id, survey_id, transect_id
from reefcensus.operators.joins import broadcast_if_small, suffix_clashes
from reefcensus.registry import FISH_LAYOUT, INVERT_LAYOUT, INVERT_METHOD, TLV_SEGMENTS


def add_species_traits(df: DataFrame, traits: DataFrame, species: str = "Species",
                       amount: str = "Amount", length: str = "Length",
                       a: str = "a", b: str = "b") -> DataFrame:
    """J4 + P20: left join the trait table on species, then
    ``weight_g = Amount * a * Length ^ b`` and ``weight_kg = weight_g / 1000``.
    Amount and Length become numbers (unparseable -> null). Columns that both
    sides have are ``c.x`` (ours) and ``c.y``."""
    # same-named columns of the two get .x / .y
    df, t = suffix_clashes(df, traits, [species])
    out = df.join(broadcast_if_small(t), species, "left")
    def ours(c: str) -> Column:
        return F.col(f"`{c}.x`" if c not in out.columns else f"`{c}`")

    amt, lng = ours(amount).try_cast("double"), ours(length).try_cast("double")
    trait = {c: F.col(f"`{c}.y`" if f"{c}.y" in out.columns else f"`{c}`") for c in (a, b)}
    weight_g = amt * (trait[a] * F.pow(lng, trait[b]))
    return out.withColumns({amount: amt, length: lng, "weight_g": weight_g,
                            "weight_kg": weight_g / F.lit(1000.0)})


def segments_frame(spark) -> DataFrame:
    return spark.createDataFrame(TLV_SEGMENTS, "Site_number int, Segment string")


def add_site_number(df: DataFrame, segment: str = "Segment", site: str = "Site") -> DataFrame:
    """``Site_number`` from the 14-segment table (literal, broadcast);
    ``Site`` takes the segment name."""
    seg = F.broadcast(segments_frame(df.sparkSession))
    out = df.join(seg, segment, "left")
    return out.withColumn(site, F.col(f"`{segment}`"))


def add_season(df: DataFrame, date: str = "Date") -> DataFrame:
    """P19."""
    return df.withColumn("Season", season(date))


def add_ids(df: DataFrame, key: str = "meta_to_deployment_id", date: str = "Date",
            transect: str = "Transect", quadrate: str | None = None) -> DataFrame:
    """``Transect_id``, ``Survey_id`` and, for quadrats, ``Quadrate_id``."""
    tid = transect_id(key, date, transect)
    cols = {"Transect_id": tid, "Survey_id": survey_id(key, date)}
    if quadrate:
        cols["Quadrate_id"] = quadrat_id(tid, quadrate)
    return df.withColumns(cols)


def tag_group(df: DataFrame, group: str) -> DataFrame:
    """Constant ``Group`` column."""
    return df.withColumn("Group", F.lit(group))


def project_layout(df: DataFrame, layout: Sequence[tuple[str, str]], carry: Sequence[str] = ()) -> DataFrame:
    """Select a fixed layout, behind the columns of ``carry`` that it does not
    have; a source column that a join has renamed is our side's, one that does
    not exist is null."""
    cols = set(df.columns)

    def source(src: str) -> Column:
        name = next((c for c in (src, f"{src}.x") if c in cols), None)
        return F.lit(None).cast("string") if name is None else F.col(f"`{name}`")

    names = {name for name, _ in layout}
    return df.select(*[F.col(f"`{c}`") for c in carry if c not in names],
                     *[source(src).alias(name) for name, src in layout])


def _as_date(df: DataFrame, col: str = "Date") -> DataFrame:
    """Year-first dates to DATE; a DATE column is kept as it is."""
    if isinstance(df.schema[col].dataType, T.DateType):
        return df
    return df.withColumn(col, parse_iso_date(col))


def _observer_renames(df: DataFrame) -> DataFrame:
    ren = {"Fish Observer": "Fish_Observer", "Invertebrate Observer": "Invertebrate_Observer"}
    return df.withColumnsRenamed({k: v for k, v in ren.items() if k in df.columns})


def format_fish(df: DataFrame, traits: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 57-column fish layout, behind the ``carry`` columns."""
    out = _as_date(_observer_renames(df))
    out = add_ids(out)
    out = add_species_traits(out, traits)
    out = add_site_number(out)
    out = add_season(out)
    return project_layout(out, FISH_LAYOUT, carry)


def format_invertebrates(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The 60-column invertebrate layout with ``Method = 'Quadrate'``,
    behind the ``carry`` columns."""
    out = _as_date(_observer_renames(df))
    out = add_ids(out, quadrate="Quadrate")
    out = add_site_number(out)
    out = out.withColumns({"Season": season("Date"), "Method": F.lit(INVERT_METHOD)})
    return project_layout(out, INVERT_LAYOUT, carry)

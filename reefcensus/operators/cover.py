"""Quadrat cover operators: legend join, point counts, percent cover, wide
species table, and the joins that assemble one row per quadrat and taxon.

J6 points x legend, G3 counts, G4 percent cover, G5 species by point,
J7 cover x taxon counts, J8 cover x species by point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefcensus.operators.grid import invert_metadata, quadrat_arrays, sheet_arrays
from reefcensus.operators.joins import null_safe_join, skew_safe_left_join
from reefcensus.registry import COVER_CATEGORIES, POINTS_PER_QUADRAT


def legend_join(points: DataFrame, legend: DataFrame, keys: Sequence[str],
                code: str = "Code") -> DataFrame:
    """Right join points to the legend on (sheet keys, Code), blank codes
    matching blank legend rows. Unknown codes drop; unused legend rows stay
    with no point (null Quadrate). Written as legend-left join so the many
    points per code never form an unsplittable hot key."""
    labelled = skew_safe_left_join(legend, points, [*keys, code], null_safe=True)
    return labelled.select(*points.columns, *[c for c in legend.columns if c not in (*keys, code)])


def cover_counts(labelled: DataFrame, keys: Sequence[str], quadrat: str = "Quadrate",
                 complexity: str = "Complexity", value: str = "Value") -> DataFrame:
    """Number of points per (quadrat, complexity, category)."""
    return (labelled.groupBy(*[F.col(f"`{c}`") for c in [*keys, quadrat, complexity, value]])
            .agg(F.count(F.lit(1)).alias("n")))


def cover_percent(labelled: DataFrame, keys: Sequence[str],
                  categories: Sequence[str] = COVER_CATEGORIES,
                  points_per_quadrat: int = POINTS_PER_QUADRAT,
                  quadrat: str = "Quadrate", complexity: str = "Complexity",
                  value: str = "Value") -> DataFrame:
    """Percent cover per quadrat, one column per category.

    ``100 * n / points_per_quadrat`` whatever was filled in, so a row need not
    sum to 100; categories with no point read 0; rows with no quadrat (legend
    entries nobody used) are dropped. The category list is explicit.
    """
    group = [F.col(f"`{c}`") for c in [*keys, quadrat, complexity]]
    wide = (labelled.groupBy(*group).pivot(value, list(categories))
            .agg(F.count(F.lit(1))))
    pct = [(F.coalesce(F.col(f"`{c}`"), F.lit(0)) * F.lit(100.0) / F.lit(points_per_quadrat)).alias(c)
           for c in categories]
    return (wide.filter(F.col(f"`{quadrat}`").isNotNull())
            .select(*[F.col(f"`{c}`") for c in [*keys, quadrat, complexity]], *pct))


def species_by_point(points: DataFrame, keys: Sequence[str], n_points: int = POINTS_PER_QUADRAT,
                     quadrat: str = "Quadrate", complexity: str = "Complexity",
                     point: str = "Point", species: str = "Species",
                     order: str = "row_idx") -> DataFrame:
    """One row per quadrat, a column per point (``1``..``16``) holding the
    species written at that point (first in sheet order)."""
    return (points.groupBy(*[F.col(f"`{c}`") for c in [*keys, quadrat, complexity]])
            .pivot(point, [str(i) for i in range(1, n_points + 1)])
            .agg(F.min_by(F.col(f"`{species}`"), F.col(f"`{order}`"))))


def cover_with_taxa(cover: DataFrame, counts: DataFrame, keys: Sequence[str],
                    quadrat: str = "Quadrate") -> DataFrame:
    """Left join quadrat cover rows to taxon counts (one row per taxon)."""
    return skew_safe_left_join(cover, counts, [*keys, quadrat])


def cover_with_species(cover: DataFrame, species_wide: DataFrame, keys: Sequence[str],
                       quadrat: str = "Quadrate", complexity: str = "Complexity") -> DataFrame:
    """Left join on (quadrat, complexity); a missing complexity matches a
    missing complexity."""
    return null_safe_join(cover, species_wide, [*keys, quadrat, complexity], "left")


def invertebrate_sheets(grid: DataFrame, keys: Sequence[str], metadata_keys: Sequence[str],
                        categories: Sequence[str] = COVER_CATEGORIES) -> DataFrame:
    """Whole invertebrate-sheet reading: metadata block recycled onto every
    quadrat row that has at least one matched code, with percent cover,
    taxon counts and the species-by-point columns; all its keys stay in the
    map ``metadata``.

    A sheet is aggregated once; the joins within it (points to legend J6,
    cover to counts J7 and to species J8) and the counts (G3-G5) are
    expressions on arrays of at most 19 and 16 entries.
    """
    sheets = invert_metadata(sheet_arrays(grid, keys), keys, metadata_keys)
    quads = quadrat_arrays(sheets, [*keys, "metadata", *metadata_keys])
    # a value for each point and legend row of its code; blank matches blank
    values = F.flatten(F.transform("points", lambda p: F.transform(
        F.filter("legend", lambda row: row["Code"].eqNullSafe(p["Code"])), lambda row: row["Value"])))
    quads = quads.withColumn("__values", values).filter(F.size("__values") > 0)

    def percent(category: str) -> Column:
        hits = F.size(F.filter("__values", lambda v: v == category))
        return (hits * F.lit(100.0) / F.lit(POINTS_PER_QUADRAT)).alias(category)

    def species(point: str) -> Column:
        return F.try_element_at(F.filter("points", lambda p: p["Point"] == point), F.lit(1))["Species"].alias(point)

    names = [str(i) for i in range(1, POINTS_PER_QUADRAT + 1)]
    whole = quads.select(*keys, "metadata", *metadata_keys, "Quadrate", "Complexity", *map(percent, categories),
                         *map(species, names), F.explode_outer("counts").alias("__count"))
    return whole.select(*keys, "metadata", *metadata_keys, "Quadrate", "Complexity",
                        *[F.col(f"`{c}`") for c in categories], F.col("__count.Taxon").alias("Taxon"),
                        F.col("__count.Count").alias("Count"), *names)

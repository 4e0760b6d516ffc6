"""Day and expedition tables.

P10 project family, P17 deployment keys, J2 unmatched deployments, J3 day
complete data, U1-U3 union by name, I1-I3 incremental builds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefcensus.functions.labels import deployment_key
from reefcensus.operators.joins import broadcast_if_small, skew_safe_left_join, suffix_clashes
from reefcensus.registry import project_family_rows

DAY_KEYS = ["expedition", "day_folder"]
DEPLOYMENT_KEY = "meta_to_deployment_id"


def family_frame(spark) -> DataFrame:
    return spark.createDataFrame(project_family_rows(), "Project string, family string")


def attach_family(df: DataFrame, project: str = "Project", family: str = "family") -> DataFrame:
    """P10: family of each row's project (null when unsupported). The project
    dimension is a literal of eight rows, so it is always broadcast."""
    dim = F.broadcast(family_frame(df.sparkSession)
                      .withColumnsRenamed({"Project": "__project", "family": family}))
    return df.join(dim, F.col(f"`{project}`") == F.col("__project"), "left").drop("__project")


def _c(name: str, cols: Sequence[str]) -> Column:
    return F.col(f"`{name}`") if name in cols else F.lit(None).cast("string")


def metadata_key(df: DataFrame, family: str = "family", name: str = DEPLOYMENT_KEY) -> DataFrame:
    """P17, plan side: ``"{First} and {Second} - {id}"`` by family, four
    observers for the juvenile families; missing parts read ``NA``."""
    c = df.columns
    first, second = _c("First Observer", c), _c("Second Observer", c)
    j = [_c("Juveniles First Observer", c), _c("Juveniles Second Observer", c)]
    fam = F.col(family)
    key = (
        F.when(fam == "Tel Aviv Transects", deployment_key(first, second, _c("Spot", c)))
        .when(fam.isin("Mediterranean Transects", "Eilat Transects"),
              deployment_key(first, second, _c("SiteID", c)))
        .when(fam == "Eilat Knolls", deployment_key(first, second, _c("KnollID", c)))
        .when(fam == "Eilat Juveniles Knolls", deployment_key(first, second, _c("KnollID", c), j))
        .when(fam.isin("Eilat Juveniles Transects", "Eilat Juveniles Artificial"),
              deployment_key(first, second, _c("SiteID", c), j))
    )
    return df.withColumn(name, key)


def sample_key(df: DataFrame, family: str = "family", name: str = DEPLOYMENT_KEY) -> DataFrame:
    """P17, sheet side: the same key from the sheet's own metadata fields
    (``Fish Observer`` / ``Invertebrate Observer`` / ``Site`` on Tel Aviv
    sheets, ``Site`` or ``Knoll`` elsewhere)."""
    c = df.columns
    first, second = _c("First Observer", c), _c("Second Observer", c)
    j = [_c("Juveniles First Observer", c), _c("Juveniles Second Observer", c)]
    fam = F.col(family)
    key = (
        F.when(fam == "Tel Aviv Transects",
               deployment_key(_c("Fish Observer", c), _c("Invertebrate Observer", c), _c("Site", c)))
        .when(fam.isin("Mediterranean Transects", "Eilat Transects"),
              deployment_key(first, second, _c("Site", c)))
        .when(fam == "Eilat Knolls", deployment_key(first, second, _c("Knoll", c)))
        .when(fam == "Eilat Juveniles Knolls", deployment_key(first, second, _c("Knoll", c), j))
        .when(fam.isin("Eilat Juveniles Transects", "Eilat Juveniles Artificial"),
              deployment_key(first, second, _c("Site", c), j))
    )
    return df.withColumn(name, key)


def day_families(meta: DataFrame, by: Sequence[str] = DAY_KEYS, family: str = "family") -> DataFrame:
    """One row per day with its family (days are few: one row per field day)."""
    return meta.select(*by, family).distinct()


def unmatched_deployments(meta: DataFrame, samples: DataFrame, by: Sequence[str] = DAY_KEYS,
                          key: str = DEPLOYMENT_KEY) -> DataFrame:
    """Planned deployments of a day with no observation row that day.
    The observation side is reduced to its distinct keys first (combined map
    side), so a deployment with a huge number of rows costs one row."""
    m = meta.select(*[F.col(f"`{c}`") for c in [*by, key]])
    s = samples.select(*[F.col(f"`{c}`") for c in [*by, key]]).distinct()
    return m.join(s, [*by, key], "left_anti").withColumn("check", F.lit("mismatching identifier"))


def day_complete(meta: DataFrame, samples: DataFrame, by: Sequence[str] = DAY_KEYS,
                 key: str = DEPLOYMENT_KEY) -> DataFrame:
    """Every planned deployment with its observation rows (left join
    within the day). Keys that repeat fan out; observations with no plan are
    not added. Same-named columns get ``.x`` / ``.y``."""
    m, s = suffix_clashes(meta, samples, [*by, key])
    return skew_safe_left_join(m, s, [*by, key])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a missing column reads null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def complete_days(stored: DataFrame, by: Sequence[str] = DAY_KEYS) -> DataFrame:
    """The days that already have a complete table."""
    return stored.select(*by).distinct()


def days_to_build(candidates: DataFrame, stored: DataFrame, by: Sequence[str] = DAY_KEYS) -> DataFrame:
    """I2 first half: candidate rows whose day is not complete yet."""
    done = broadcast_if_small(complete_days(stored, by))
    return candidates.join(done, list(by), "left_anti")


def skip_complete(built: DataFrame, stored: DataFrame) -> DataFrame:
    """I2 second half: freshly built days stacked on the stored ones."""
    return union_by_name([built, stored])


def join_days(stored: DataFrame, expedition: str | None = None,
              expedition_col: str = "expedition") -> DataFrame:
    """The stored day tables of one expedition (partition-pruned)."""
    return stored if expedition is None else stored.filter(F.col(expedition_col) == expedition)

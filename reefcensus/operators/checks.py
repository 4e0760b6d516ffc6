"""Validation operators: each returns a DataFrame of violations.

P8 single-value checks, P9 missing observers, P25 layout cutoff. A run that
must stop on violations calls ``fail_on`` (one bounded ``limit(1)`` probe).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reefcensus.functions.text import na_text
from reefcensus.registry import project_family_rows


class SurveyCheckError(RuntimeError):
    """Raised by ``fail_on`` when a check finds violations."""


def single_value_violations(df: DataFrame, by: Sequence[str], col: str,
                            check: str | None = None) -> DataFrame:
    """Groups where ``col`` takes more than one value (a missing value counts
    as a value). Reports the count and the least / greatest value text."""
    c = F.col(f"`{col}`")
    out = (
        df.groupBy(*[F.col(f"`{b}`") for b in by])
        .agg(
            (F.count_distinct(c) + F.max(c.isNull().cast("int"))).cast("long").alias("n_values"),
            F.min(na_text(c)).alias("least_value"),
            F.max(na_text(c)).alias("greatest_value"),
        )
        .filter(F.col("n_values") > 1)
    )
    return out.withColumn("check", F.lit(check or f"one {col}"))


def unsupported_projects(df: DataFrame, by: Sequence[str], project: str = "Project") -> DataFrame:
    """Rows whose project belongs to no family, reported per group."""
    spark = df.sparkSession
    known = spark.createDataFrame(project_family_rows(), "Project string, family string")
    return (
        df.select(*[F.col(f"`{b}`") for b in by], F.col(f"`{project}`").alias("Project"))
        .join(F.broadcast(known.select("Project")), "Project", "left_anti")
        .distinct()
        .withColumn("check", F.lit("supported project"))
    )


def missing_counts(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per group, how many rows miss each column; only groups missing any."""
    present = [c for c in cols if c in df.columns]
    aggs = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"missing {c}") for c in present]
    out = df.groupBy(*[F.col(f"`{b}`") for b in by]).agg(*aggs)
    any_missing = None
    for c in present:
        cond = F.col(f"`missing {c}`") > 0
        any_missing = cond if any_missing is None else (any_missing | cond)
    return out.filter(any_missing) if any_missing is not None else out.limit(0)


def before_cutoff(df: DataFrame, date_col: str, cutoff: str,
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows (or groups) dated before the layout cutoff."""
    bad = df.filter(F.col(f"`{date_col}`") < F.to_date(F.lit(cutoff)))
    cols = list(by) + [date_col]
    return bad.select(*[F.col(f"`{c}`") for c in cols]).distinct().withColumn(
        "check", F.lit(f"date before {cutoff}"))


def fail_on(violations: DataFrame, what: str = "survey check") -> DataFrame:
    """Raise when a violations DataFrame is not empty; else return it."""
    hit = violations.limit(1).collect()
    if hit:
        raise SurveyCheckError(f"{what} failed, first violation: {hit[0].asDict()}")
    return violations

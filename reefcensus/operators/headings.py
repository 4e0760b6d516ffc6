"""Headings of sheets and plan files: unique names, survey renames, and what
makes a file unreadable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reefcensus.registry import HEADING_DROPS, HEADING_RENAMES

#: position suffixes that a reader has added to a name before
_SUFFIX = r"(\.\.\.[0-9]*)+$"


def bare_names(header: Column | str) -> Column:
    """Headings without position suffixes; blank ones are ``''``."""
    h = F.col(header) if isinstance(header, str) else header
    return F.transform(h, lambda x: F.coalesce(F.trim(F.regexp_replace(x, _SUFFIX, "")), F.lit("")))


def repaired_names(header: Column | str) -> Column:
    """Unique headings: a blank one is ``...N``, each one of a repeated name
    is ``name...N`` (N: its 1-based place)."""
    names = bare_names(header)
    return F.transform(names, lambda x, i: F.when(
        (x == "") | (F.size(F.filter(names, lambda y: y == x)) > 1),
        F.concat(x, F.lit("..."), (i + 1).cast("string"))).otherwise(x))


def survey_name(name: Column) -> Column:
    """The survey's name of a heading (``Site`` is ``SiteID`` ...)."""
    out = None
    for old, new in HEADING_RENAMES.items():
        out = F.when(name == old, F.lit(new)) if out is None else out.when(name == old, F.lit(new))
    return out.otherwise(name)


def survey_names(header: Column | str) -> Column:
    """Repaired headings under the survey's names; dropped ones are null, as
    is a name that an earlier heading has already."""
    names = F.transform(repaired_names(header), survey_name)
    return F.transform(names, lambda x, i: F.when(
        ~x.isin(list(HEADING_DROPS)) & (F.array_position(names, x) == i + 1), x))


def conflicting_names(header: Column | str) -> Column:
    """Survey names that two different headings stand for."""
    names = F.transform(repaired_names(header), survey_name)
    return F.array_distinct(F.filter(names, lambda x, i: F.array_position(names, x) < i + 1))


def missing_names(header: Column | str, required: Sequence[str]) -> Column:
    """Required survey names that no heading stands for."""
    return F.array_except(F.array(*[F.lit(c) for c in required]),
                          F.filter(survey_names(header), lambda x: x.isNotNull()))

"""Labels and identifiers derived from sheet names and metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reefcensus.functions.text import na_text
from reefcensus.registry import (
    GROUP_FLAG_MATCH,
    GROUP_FLAG_OTHER,
    GROUP_FLAG_TOKEN,
    LAYER_LETTER_PATTERNS,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def layer_letter(sheet: str | Column,
                 patterns: Sequence[tuple[str, str]] = LAYER_LETTER_PATTERNS) -> Column:
    """First regex pattern found in the sheet name gives the letter; else null."""
    s = _col(sheet)
    expr = None
    for pattern, letter in patterns:
        cond = s.rlike(pattern)
        expr = F.when(cond, F.lit(letter)) if expr is None else expr.when(cond, F.lit(letter))
    return expr


def group_flag(sheet: str | Column, token: str = GROUP_FLAG_TOKEN,
               match: str = GROUP_FLAG_MATCH, other: str = GROUP_FLAG_OTHER) -> Column:
    """``Fish`` when the sheet name matches the token, else ``Invertebrates``;
    a missing sheet name stays missing."""
    s = _col(sheet)
    return F.when(s.rlike(token), F.lit(match)).when(s.isNotNull(), F.lit(other))


def deployment_key(first: str | Column, second: str | Column, place: str | Column,
                   juveniles: Sequence[str | Column] | None = None) -> Column:
    """``"{first} and {second}[ and {j1} and {j2}] - {place}"`` with NA text."""
    parts = [na_text(first), F.lit(" and "), na_text(second)]
    for j in juveniles or ():
        parts += [F.lit(" and "), na_text(j)]
    parts += [F.lit(" - "), na_text(place)]
    return F.concat(*parts)


def _date_text(d: str | Column) -> Column:
    return na_text(F.date_format(_col(d), "yyyy-MM-dd"))


def survey_id(key: str | Column, date: str | Column) -> Column:
    """``{key}_{date}``."""
    return F.concat(na_text(key), F.lit("_"), _date_text(date))


def transect_id(key: str | Column, date: str | Column, transect: str | Column) -> Column:
    """``{key}_{date}_{transect}``."""
    return F.concat(na_text(key), F.lit("_"), _date_text(date), F.lit("_"), na_text(transect))


def quadrat_id(transect: str | Column, quadrate: str | Column) -> Column:
    """``{transect_id} {quadrate}``: joined with a space, as the layout has it."""
    return F.concat(na_text(transect), F.lit(" "), na_text(quadrate))

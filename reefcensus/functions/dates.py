"""Date rules: day-first text dates, ISO dates, seasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reefcensus.registry import SEASON_MONTHS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day_first(c: str | Column) -> Column:
    """``26/10/2021``, ``22.6.2021``, ``1.1.21`` -> DATE; unparseable -> null.

    Separators ``.``, ``-`` and ``/`` are equivalent; a two-digit year is in
    the 2000s. Never throws under ANSI mode.
    """
    t = F.regexp_replace(F.trim(_col(c).cast("string")), "[./-]", "/")
    two_digit_year = t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$")
    return F.when(two_digit_year, F.try_to_date(t, "d/M/yy")).otherwise(
        F.try_to_date(t, "d/M/y"))


def parse_iso_date(c: str | Column) -> Column:
    """Year-first dates (``2021-11-07``); dates and timestamps pass through."""
    col = _col(c)
    return F.coalesce(
        F.try_to_date(F.trim(col.cast("string")), "y-M-d"),
        F.to_date(col.try_cast("timestamp")),
    )


def season(date_col: str | Column) -> Column:
    """Meteorological season of the month of a date."""
    m = F.month(_col(date_col))
    expr = None
    for name, months in SEASON_MONTHS.items():
        expr = (F.when(m.isin(months), F.lit(name)) if expr is None
                else expr.when(m.isin(months), F.lit(name)))
    return expr

"""SQL text for the DuckDB oracle: the same value rules as the Spark
expressions in ``reefcensus.functions``, written as ANSI-ish SQL."""

from __future__ import annotations

from reefcensus.registry import NA_TEXT

_SCI_RE = r"'^([0-9])\.([0-9]+)e([+-][0-9]+)$'"
_NUM_RE = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def na(x: str) -> str:
    """Text of a value, ``NA`` when missing."""
    return f"coalesce(CAST({x} AS VARCHAR), '{NA_TEXT}')"


def canon_double(x: str) -> str:
    """15 significant digits, fixed unless scientific is shorter."""
    s = f"printf('%.14e', abs({x}))"
    lead = f"regexp_extract({s}, {_SCI_RE}, 1)"
    frac = f"regexp_extract({s}, {_SCI_RE}, 2)"
    exp = f"CAST(regexp_extract({s}, {_SCI_RE}, 3) AS INTEGER)"
    digits = f"rtrim({lead} || {frac}, '0')"
    k = f"length({digits})"
    fixed = (f"(CASE WHEN {exp} >= 0 THEN (CASE WHEN {k} <= {exp} + 1 "
             f"THEN {digits} || repeat('0', {exp} + 1 - {k}) "
             f"ELSE substr({digits}, 1, {exp} + 1) || '.' || substr({digits}, {exp} + 2) END) "
             f"ELSE '0.' || repeat('0', -{exp} - 1) || {digits} END)")
    sci = (f"(substr({digits}, 1, 1) || (CASE WHEN {k} > 1 THEN '.' || substr({digits}, 2) ELSE '' END)"
           f" || 'e' || (CASE WHEN {exp} < 0 THEN '-' ELSE '+' END) || lpad(CAST(abs({exp}) AS VARCHAR), 2, '0'))")
    body = f"(CASE WHEN length({fixed}) <= length({sci}) THEN {fixed} ELSE {sci} END)"
    return (f"(CASE WHEN {x} = 0 THEN '0' WHEN isnan({x}) THEN 'NaN' "
            f"ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || {body} END)")


def canon_text(x: str) -> str:
    t = f"trim(CAST({x} AS VARCHAR))"
    as_long = f"TRY_CAST({t} AS BIGINT)"
    as_double = f"TRY_CAST({t} AS DOUBLE)"
    return (
        f"(CASE WHEN {t} IS NULL OR {t} = '' OR {t} = '{NA_TEXT}' THEN NULL "
        f"WHEN {t} IN ('T', 'TRUE', 'true', 'True') THEN 'TRUE' "
        f"WHEN {t} IN ('F', 'FALSE', 'false', 'False') THEN 'FALSE' "
        f"WHEN regexp_matches({t}, '^[+-]?[0-9]+$') AND {as_long} IS NOT NULL "
        f"AND abs({as_long}) <= 2147483647 THEN CAST({as_long} AS VARCHAR) "
        f"WHEN regexp_matches({t}, {_NUM_RE}) AND {as_double} IS NOT NULL THEN {canon_double(as_double)} "
        f"ELSE {t} END)"
    )


def ymd(x: str) -> str:
    return f"strftime(CAST({x} AS DATE), '%Y-%m-%d')"


def season(x: str) -> str:
    from reefcensus.registry import SEASON_MONTHS
    whens = " ".join(f"WHEN month({x}) IN ({', '.join(map(str, m))}) THEN '{n}'" for n, m in SEASON_MONTHS.items())
    return f"(CASE {whens} END)"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'

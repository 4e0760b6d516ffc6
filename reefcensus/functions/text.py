"""Text rules of the survey sheets, as built-in Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from reefcensus.registry import NA_TEXT

_TRUE_WORDS = ["T", "TRUE", "true", "True"]
_FALSE_WORDS = ["F", "FALSE", "false", "False"]
_INT_RE = r"^[+-]?[0-9]+$"
_NUM_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INT32_MAX = 2147483647


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_text(c: str | Column) -> Column:
    """Text of a value where a missing value reads ``NA`` (rule S1)."""
    return F.coalesce(_col(c).cast("string"), F.lit(NA_TEXT))


def glue(template: str, **cols: str | Column) -> Column:
    """Fill ``{name}`` slots of a template with column text, NA for nulls.

    ``glue("{a} and {b} - {site}", a="First Observer", ...)``; a slot with no
    keyword argument names a column directly.
    """
    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{([^{}]+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        parts.append(na_text(cols.get(name, name)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def strip_repair_suffix(c: str | Column) -> Column:
    """Header repair undo: ``Observer...3`` -> ``Observer``."""
    return F.split(_col(c), r"\.\.\.").getItem(0)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a one-element array
    transform binds it to a lambda variable, so the expression tree does not
    repeat ``value`` at every use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _double_text(d: Column) -> Column:
    """A double as text with 15 significant digits, fixed or scientific,
    whichever is not longer (fixed wins ties)."""
    parts = F.split(F.format_string("%.14e", F.abs(d)), "e")
    digits = F.regexp_replace(F.replace(F.try_element_at(parts, F.lit(1)), F.lit("."), F.lit("")), "0+$", "")
    exp = F.try_element_at(parts, F.lit(2)).cast("int")

    def render(r: Column) -> Column:
        g, e = r["g"], r["e"]
        k = F.length(g)
        fixed = (F.when(e >= 0,
                        F.when(k <= e + 1, F.concat(g, F.repeat(F.lit("0"), e + 1 - k)))
                        .otherwise(F.concat(F.substr(g, F.lit(1), e + 1), F.lit("."), F.substr(g, e + 2))))
                 .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), g)))
        sci = F.concat(F.substr(g, F.lit(1), F.lit(1)),
                       F.when(k > 1, F.concat(F.lit("."), F.substr(g, F.lit(2)))).otherwise(F.lit("")),
                       F.lit("e"), F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
                       F.lpad(F.abs(e).cast("string"), 2, "0"))
        return _let(F.struct(fixed.alias("f"), sci.alias("s")),
                    lambda b: F.when(F.length(b["f"]) <= F.length(b["s"]), b["f"]).otherwise(b["s"]))

    body = _let(F.struct(digits.alias("g"), exp.alias("e")), render)
    return (
        F.when(d == 0, F.lit("0"))
        .when(d.isNaN(), F.lit("NaN"))
        .otherwise(F.concat(F.when(d < 0, F.lit("-")).otherwise(F.lit("")), body))
    )


def canonical_text(c: str | Column) -> Column:
    """Per-value type guess, rendered back to text (rule S7).

    Blank and ``NA`` -> null; logical words -> ``TRUE``/``FALSE``; integers
    that fit 32 bits lose leading zeros (``007`` -> ``7``); other numbers get
    15 significant digits without trailing zeros (``10.50`` -> ``10.5``);
    anything else is kept as trimmed text.
    """
    def rule(t: Column) -> Column:
        as_long = t.try_cast("bigint")
        as_double = t.try_cast("double")
        is_int = t.rlike(_INT_RE) & as_long.isNotNull() & (F.abs(as_long) <= _INT32_MAX)
        is_num = t.rlike(_NUM_RE) & as_double.isNotNull()
        return (
            F.when(t.isNull() | (t == "") | (t == NA_TEXT), F.lit(None).cast("string"))
            .when(t.isin(_TRUE_WORDS), F.lit("TRUE"))
            .when(t.isin(_FALSE_WORDS), F.lit("FALSE"))
            .when(is_int, as_long.cast("string"))
            .when(is_num, _double_text(as_double))
            .otherwise(t)
        )
    return _let(F.trim(_col(c).cast("string")), rule)


def with_canonical(df, columns: dict[str, str | Column]):
    """Add canonical-text columns (same rule as ``canonical_text``) in staged
    projections: every intermediate value is its own column, so each is
    computed once per row and the whole rule stays in generated code (the
    optimizer keeps the stages apart because later stages use an expensive
    value more than once)."""
    tmp: list[str] = []

    def t(name: str, i: int) -> str:
        n = f"__c{i}_{name}"
        tmp.append(n)
        return n

    out = df
    stage1, stage1b, stage2, stage3, stage4, final = {}, {}, {}, {}, {}, {}
    for i, (name, src) in enumerate(columns.items()):
        tt, it, lg, db, g, e, fx, sc = (t(x, i) for x in ("t", "i", "l", "d", "g", "e", "f", "s"))
        stage1[tt] = F.trim(_col(src).cast("string"))
        tc = F.col(tt)
        stage1b[it] = F.when(tc.rlike(_INT_RE), tc.try_cast("bigint"))
        ic = F.col(it)
        small = F.abs(ic) <= _INT32_MAX
        stage2[lg] = F.when(small, ic)
        # the double (and its formatting below) only for numbers that are not
        # 32-bit integers; text and integers skip the costly branch
        stage2[db] = F.when(ic.isNull() | ~small, F.when(tc.rlike(_NUM_RE), tc.try_cast("double")))
        dc = F.col(db)
        parts = F.when(dc.isNotNull() & (dc != 0) & ~dc.isNaN(),
                       F.split(F.format_string("%.14e", F.abs(dc)), "e"))
        stage3[g] = F.regexp_replace(F.replace(F.try_element_at(parts, F.lit(1)), F.lit("."), F.lit("")), "0+$", "")
        stage3[e] = F.try_element_at(parts, F.lit(2)).cast("int")
        gc, ec = F.col(g), F.col(e)
        k = F.length(gc)
        stage4[fx] = (F.when(ec >= 0,
                             F.when(k <= ec + 1, F.concat(gc, F.repeat(F.lit("0"), ec + 1 - k)))
                             .otherwise(F.concat(F.substr(gc, F.lit(1), ec + 1), F.lit("."), F.substr(gc, ec + 2))))
                      .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -ec - 1), gc)))
        stage4[sc] = F.concat(F.substr(gc, F.lit(1), F.lit(1)),
                              F.when(k > 1, F.concat(F.lit("."), F.substr(gc, F.lit(2)))).otherwise(F.lit("")),
                              F.lit("e"), F.when(ec < 0, F.lit("-")).otherwise(F.lit("+")),
                              F.lpad(F.abs(ec).cast("string"), 2, "0"))
        lc = F.col(lg)
        num = (F.when(dc == 0, F.lit("0")).when(dc.isNaN(), F.lit("NaN"))
               .otherwise(F.concat(F.when(dc < 0, F.lit("-")).otherwise(F.lit("")),
                                   F.when(F.length(fx) <= F.length(sc), F.col(fx)).otherwise(F.col(sc)))))
        final[name] = (
            F.when(tc.isNull() | (tc == "") | (tc == NA_TEXT), F.lit(None).cast("string"))
            .when(tc.isin(_TRUE_WORDS), F.lit("TRUE"))
            .when(tc.isin(_FALSE_WORDS), F.lit("FALSE"))
            .when(lc.isNotNull(), lc.cast("string"))
            .when(dc.isNotNull(), num)
            .otherwise(tc))
    for stage in (stage1, stage1b, stage2, stage3, stage4, final):
        out = out.withColumns(stage)
    return out.drop(*tmp)

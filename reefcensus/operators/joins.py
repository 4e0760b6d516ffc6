"""Join helpers: null-safe equi-joins and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when the optimiser's size estimate is at most this
# many bytes; otherwise the join stays a shuffle join (AQE may still convert it
# from runtime sizes).
LOOKUP_BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = LOOKUP_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind the optimiser's size estimate (no job runs). A
    table whose estimate is larger or unknown stays a shuffle join, which AQE
    may still turn into a broadcast from sizes at run time."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join where a missing key matches a missing key (dplyr rule).

    The result has one copy of each key column (from the side that is kept).
    Spark still plans this as a hashed equi-join.
    """
    r = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") if c in keys else F.col(f"`{c}`")
                       for c in right.columns])
    cond = reduce(lambda a, b: a & b,
                  [left[f"`{k}`"].eqNullSafe(r[f"`__r_{k}`"]) for k in keys])
    joined = left.join(r, cond, how)
    out = []
    for c in left.columns:
        if c in keys:
            if how in ("right", "right_outer", "full", "full_outer", "outer"):
                out.append(F.coalesce(left[f"`{c}`"], r[f"`__r_{c}`"]).alias(c))
            else:
                out.append(left[f"`{c}`"])
        else:
            out.append(left[f"`{c}`"])
    if how in ("left_anti", "anti", "left_semi", "semi"):
        return joined.select(*out)
    out += [r[f"`{c}`"] for c in r.columns if not c.startswith("__r_")]
    return joined.select(*out)


def suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   suffixes: tuple[str, str] = (".x", ".y")) -> tuple[DataFrame, DataFrame]:
    """Rename same-named non-key columns ``c.x`` / ``c.y`` before a join."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if not clash:
        return left, right
    lx = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    ry = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return lx, ry


def conditional_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                          when_col: str, when_value) -> DataFrame:
    """Left join applied only to rows whose ``when_col`` equals ``when_value``
    (others keep nulls on the right side); still one hashed equi-join."""
    r = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") if c in keys else F.col(f"`{c}`")
                       for c in right.columns if c != when_col])
    cond = reduce(lambda a, b: a & b,
                  [left[f"`{k}`"].eqNullSafe(r[f"`__r_{k}`"]) for k in keys])
    cond = cond & (left[f"`{when_col}`"] == F.lit(when_value))
    joined = left.join(r, cond, "left")
    return joined.select(*[left[f"`{c}`"] for c in left.columns],
                         *[r[f"`{c}`"] for c in r.columns if not c.startswith("__r_")])


def skew_safe_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        null_safe: bool = False) -> DataFrame:
    """``left LEFT JOIN right`` as an inner join plus the unmatched left rows.

    Adaptive execution can split a hot key on either side of an inner join
    (and may broadcast either side), but cannot split the right side of a
    left outer join. The unmatched rows come from an anti join against the
    right side's distinct keys (one row per key after a map-side combine).
    The result has the same rows as the outer join.
    """
    keys = list(keys)
    right_keys = right.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    if null_safe:
        matched = null_safe_join(left, right, keys, "inner")
        unmatched = null_safe_join(left, right_keys, keys, "left_anti")
    else:
        matched = left.join(right, keys, "inner")
        unmatched = left.join(right_keys, keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)

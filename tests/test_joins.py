"""Join helpers: skew-safe left join equals the outer join; null-safe joins;
size-checked broadcasts."""

from __future__ import annotations

import random

from reefcensus.operators.joins import broadcast_if_small, null_safe_join, skew_safe_left_join
from tests.conftest import rows


def _frames(spark, seed):
    rnd = random.Random(seed)
    keys = ["hot"] * 30 + ["a", "b", "c", None]
    left = [(rnd.choice(keys + ["lonely"]), i) for i in range(60)]
    right = [(rnd.choice(keys + ["orphan"]), i * 10) for i in range(200)]  # one key holds most rows
    return (spark.createDataFrame(left, "k string, lv int"),
            spark.createDataFrame(right, "k string, rv int"))


def test_skew_safe_left_join_equals_outer_join(spark):
    for seed in (1, 2, 3):
        left, right = _frames(spark, seed)
        want = rows(left.join(right, "k", "left"), "k", "lv", "rv")
        got = rows(skew_safe_left_join(left, right, ["k"]), "k", "lv", "rv")
        assert got == want
        want_ns = rows(null_safe_join(left, right, ["k"], "left"), "k", "lv", "rv")
        got_ns = rows(skew_safe_left_join(left, right, ["k"], null_safe=True), "k", "lv", "rv")
        assert got_ns == want_ns
        # null keys match each other only in the null-safe form
        assert any(r[0] is None and r[2] is not None for r in got_ns)
        assert not any(r[0] is None and r[2] is not None for r in got)


def test_broadcast_only_below_the_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    hinted = broadcast_if_small(small, 100)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(big, 100)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower()
    assert "broadcast" not in plain.lower()

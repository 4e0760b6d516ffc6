"""Value rules: S1 NA text, S6 dates, S7 canonical text, seasons, letters."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reefcensus.functions import (
    canonical_text,
    deployment_key,
    glue,
    group_flag,
    layer_letter,
    parse_day_first,
    quadrat_id,
    season,
    transect_id,
)
from reefcensus.functions.text import with_canonical

CANON = [
    ("10.50", "10.5"), ("10.0", "10"), ("007", "7"), ("T", "TRUE"), ("F", "FALSE"),
    ("true", "TRUE"), ("NA", None), ("", None), ("   ", None), (None, None),
    ("100000", "100000"), ("100000.0", "1e+05"), ("123456.7", "123456.7"), ("0.0001", "1e-04"),
    ("0.001", "0.001"), ("-2.50", "-2.5"), ("1e3", "1000"), ("12345678901", "12345678901"),
    ("0.1", "0.1"), ("Blue Spot", "Blue Spot"), ("  Spot 3 ", "Spot 3"), ("10:30", "10:30"),
    ("+5", "5"), ("0", "0"), ("0.30000000000000004", "0.3"),
]


def test_canonical_text_rule(spark):
    df = spark.createDataFrame([(a,) for a, _ in CANON], "v string")
    got = dict((r["v"], r["c"]) for r in df.select("v", canonical_text("v").alias("c")).collect())
    staged = dict((r["v"], r["c"]) for r in with_canonical(df, {"c": "v"}).collect())
    for raw, want in CANON:
        assert got[raw] == want, raw
        assert staged[raw] == want, raw


def test_na_text_and_glue(spark):
    df = spark.createDataFrame([("Obs One", None, "3")], "a string, b string, s string")
    r = df.select(glue("{a} and {b} - {s}").alias("g"),
                  deployment_key("a", "b", "s").alias("k"),
                  deployment_key("a", "b", "s", juveniles=["b", "a"]).alias("j")).first()
    assert r["g"] == "Obs One and NA - 3"
    assert r["k"] == "Obs One and NA - 3"
    assert r["j"] == "Obs One and NA and NA and Obs One - 3"


@pytest.mark.parametrize("text,want", [
    ("26/10/2021", dt.date(2021, 10, 26)), ("22.6.2021", dt.date(2021, 6, 22)),
    ("1.1.2021", dt.date(2021, 1, 1)), ("08.08.2021", dt.date(2021, 8, 8)),
    ("1.1.21", dt.date(2021, 1, 1)), ("17/06/2020", dt.date(2020, 6, 17)),
    ("31/02/2021", None), ("", None), ("soon", None),
])
def test_day_first_dates(spark, text, want):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(parse_day_first("d").alias("x")).first()["x"] == want


def test_season_months(spark):
    df = spark.createDataFrame([(dt.date(2021, m, 1),) for m in range(1, 13)], "d date")
    got = [r["s"] for r in df.orderBy("d").select(season("d").alias("s")).collect()]
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                   "Fall", "Fall", "Fall", "Winter"]


def test_layer_letter_first_match_and_group_flag(spark):
    names = ["Site 1 - Transect A - TRANSIENTS", "Site 1 - Transect A - CRYPTIC",
             "Site 1 - Transect B - Juveniles", "Site 2 - Transect C - CRYPTIC - Juveniles",
             "Site 3 - Transect D", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    got = {r["s"]: (r["l"], r["g"]) for r in
           df.select("s", layer_letter("s").alias("l"), group_flag("s").alias("g")).collect()}
    assert got["Site 1 - Transect A - TRANSIENTS"][0] == "T"
    assert got["Site 1 - Transect A - CRYPTIC"][0] == "C"
    assert got["Site 1 - Transect B - Juveniles"][0] == "J"
    assert got["Site 2 - Transect C - CRYPTIC - Juveniles"][0] == "C"
    assert got["Site 3 - Transect D"][0] is None
    fish = spark.createDataFrame([("3 - A - Fish",), ("3 - A - Invertebrates",), (None,)], "s string")
    flags = {r["s"]: r["g"] for r in fish.select("s", group_flag("s").alias("g")).collect()}
    assert flags == {"3 - A - Fish": "Fish", "3 - A - Invertebrates": "Invertebrates", None: None}


def test_ids_keep_space_in_quadrat_id(spark):
    df = spark.createDataFrame([("k", dt.date(2021, 11, 7), "A", 2)], "k string, d date, t string, q int")
    r = df.select(transect_id("k", "d", "t").alias("t"),
                  quadrat_id(transect_id("k", "d", "t"), "q").alias("q")).first()
    assert r["t"] == "k_2021-11-07_A"
    assert r["q"] == "k_2021-11-07_A 2"
    assert df.select(transect_id("k", F.lit(None).cast("date"), F.lit(None)).alias("t")).first()["t"] == "k_NA_NA"


def _python_rule(text: str) -> str:
    """The canonical-number rule in plain Python, for the property test."""
    d = float(text)
    if d == 0:
        return "0"
    mant, exp = f"{abs(d):.14e}".split("e")
    digits, e = mant.replace(".", "").rstrip("0"), int(exp)
    k = len(digits)
    if e >= 0:
        fixed = digits + "0" * (e + 1 - k) if k <= e + 1 else digits[:e + 1] + "." + digits[e + 1:]
    else:
        fixed = "0." + "0" * (-e - 1) + digits
    sci = digits[0] + ("." + digits[1:] if k > 1 else "") + "e" + ("-" if e < 0 else "+") + f"{abs(e):02d}"
    return ("-" if d < 0 else "") + (fixed if len(fixed) <= len(sci) else sci)


def test_canonical_numbers_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    decimals = st.builds(
        lambda sign, whole, frac, exp: f"{sign}{whole}{'.' + frac if frac else ''}{'e' + str(exp) if exp else ''}",
        st.sampled_from(["", "-"]), st.integers(0, 10**9), st.text("0123456789", max_size=6),
        st.sampled_from([None, -7, -3, 2, 9]))

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(decimals, min_size=200, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        got = {r["v"]: r["c"] for r in with_canonical(df, {"c": "v"}).collect()}
        for v in values:
            as_int = v.lstrip("-").isdigit() and abs(int(v)) <= 2147483647
            want = str(int(v)) if as_int else _python_rule(v)
            assert got[v] == want, v

    check()

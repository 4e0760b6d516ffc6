"""P1, P2, P3/P4, P11, P12, P18."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from reefcensus.operators import clean
from tests.conftest import rows


def _expected_fill(data, by_idx, order_idx, fill_idx):
    groups = {}
    for r in sorted(data, key=lambda r: (str(r[by_idx]), r[order_idx])):
        groups.setdefault(r[by_idx], []).append(list(r))
    out = []
    for g in groups.values():
        last = {i: None for i in fill_idx}
        for r in g:
            for i in fill_idx:
                if r[i] is None:
                    r[i] = last[i]
                else:
                    last[i] = r[i]
            out.append(tuple(r))
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_fill_down_matches_sequential_scan_across_chunks(spark):
    rnd = random.Random(7)
    data = []
    for pos in range(400):
        grp = rnd.choice(["a", "a", "a", "b", None])  # one hot group, a null group
        v = rnd.choice([None, None, None, rnd.randint(0, 9)])
        s = rnd.choice([None, None, "x", "y"])
        data.append((grp, pos, v, s))
    df = spark.createDataFrame(data, "g string, pos long, v int, s string")
    got = clean.fill_down(df, ["g"], "pos", ["v", "s"], chunk_rows=7)
    assert rows(got, "g", "pos", "v", "s") == _expected_fill(data, 0, 1, [2, 3])
    # one chunk only gives the same answer
    got1 = clean.fill_down(df, ["g"], "pos", ["v", "s"])
    assert rows(got1, "g", "pos", "v", "s") == _expected_fill(data, 0, 1, [2, 3])


def test_fill_down_except_keeps_observers(spark):
    data = [("f", 1, "Israel", "Bioblitz", "1", "Obs One", "Obs Two"),
            ("f", 2, None, None, "2", None, "Obs Two"),
            ("f", 3, None, None, None, None, None)]  # comma-only row stays a row
    df = spark.createDataFrame(data, "file string, row_idx int, Country string, Project string, "
                                     "SiteID string, `First Observer` string, `Second Observer` string")
    got = clean.fill_down_except(df, ["file"], "row_idx", ["First Observer", "Second Observer"])
    assert rows(got, "row_idx", "Country", "SiteID", "First Observer") == [
        (1, "Israel", "1", "Obs One"), (2, "Israel", "2", None), (3, "Israel", "2", None)]


def test_headings_and_defaults(spark):
    df = spark.createDataFrame([("City Coast Project", "Spot 1", "Obs One", "Obs Two", "1")],
                               "Expedition string, Site string, `Fish Observer` string, "
                               "`Invertebrate Observer` string, Dive string")
    out = clean.add_defaults(clean.normalise_headings(df), project="TLV")
    assert out.columns == ["Country", "Project", "Expedition", "SiteID", "First Observer", "Second Observer"]
    r = out.first()
    assert (r["Country"], r["Project"]) == ("Israel", "TLV")
    kept = clean.add_defaults(spark.createDataFrame([("Greece", "X", "E")], "Country string, Project string, "
                                                                             "Expedition string"), "TLV")
    assert kept.first().asDict() == {"Country": "Greece", "Project": "X", "Expedition": "E"}


def test_presence_filters(spark):
    df = spark.createDataFrame([("a", "1", None), ("b", None, None), (None, "2", "3")],
                               "Species string, Amount string, Spot string")
    # Observer and Length do not exist: only Species and Amount are required
    assert rows(clean.complete_rows(df, ["Observer", "Species", "Amount", "Length"]), "Species") == [("a",)]
    assert len(clean.any_present(df, ["Site", "SiteID", "Knoll", "Spot"]).collect()) == 1


def test_zero_fill(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2.0, "x"), (3, 4.0, None)],
                               "Quadrate int, cover double, note string")
    got = rows(clean.zero_fill(df, "Quadrate"), "Quadrate", "cover", "note")
    assert got == [(1, 0.0, "0"), (3, 4.0, "0")]
    assert clean.zero_fill(df, "Quadrate").schema["cover"].dataType.typeName() == "double"
    assert F is not None


def test_rows_of_a_hot_group_are_numbered_in_chunks(spark):
    from reefcensus.operators.clean import number_rows

    data = [("hot", None, i) for i in range(997)] + [("small", "x", 5), ("small", "x", 900), (None, None, 3)]
    df = spark.createDataFrame(data, "a string, b string, row_idx int").repartition(7)
    out = number_rows(df, ["a", "b"], "row_idx", "place", chunk_rows=64)
    assert out.columns == ["a", "b", "row_idx", "place"]
    got = {(r["a"], r["row_idx"]): r["place"] for r in out.collect()}
    assert got == {("hot", i): i for i in range(997)} | {("small", 5): 0, ("small", 900): 1, (None, 3): 0}


def test_a_hot_pair_has_its_sheets_in_order(spark):
    from reefcensus.operators.surveyors import surveyor_rows, worksheet_manifest

    n = 300
    plan = spark.createDataFrame(
        [("f", i, "EcoCamp", "Eilat Knolls", "Obs One", "Obs Two", str(i)) for i in range(n)],
        "file string, row_idx int, Project string, family string, `First Observer` string, `Second Observer` string, "
        "KnollID string")
    emails = spark.createDataFrame([("Obs One", "one@reef.example")], "FullName string, email string")
    long = surveyor_rows(plan, emails)
    # the only windows are over chunks of a pair, or over its chunk counts
    windows = [x for x in long._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert windows and all("__chunk" in x for x in windows)
    got = worksheet_manifest(long, ["file"]).orderBy("dep_order").collect()
    assert [(r["dep_order"], r["sheet"]) for r in got] == [(i, f"Knoll {i}") for i in range(n)]

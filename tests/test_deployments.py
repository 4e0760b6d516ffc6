"""Deployment side end to end on plan CSVs (A1, P1-P5, P8-P10, G1, J1, G2,
G6, R1-R3), on invented plans."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reefcensus.plans.deployment import plan_checks, plan_from_csvs, plan_products
from reefcensus.sources.deployments import read_deployments
from tests.conftest import rows, write_csv

TRANSECTS = """Project,Country,Location,Expedition,Date,First Observer,Second Observer,SiteID,Notes
ASSEMBLE,Israel,South Jetty,Harbour Watch 2023,03/05/2023,Obs Three,,P7,"calm, clear"
,,,,,Obs One,Obs Two,P8,
,,,,,,,,
,,,,,Obs One,Obs Two,P9,"said ""go"" twice"
"""

BEACH = """Project,Spot,Lat,Lon,Location,Expedition,Date,Fish Observer,Invertebrate Observer
TLV,Pier End  ,30 10.500,31 20.600,Long Beach,Beach Series,14.2.2022,Obs Four,Obs Five
,Kelp Wall,,,,,,Obs Five,Obs Four
"""

DIVE = """Project,Country,Expedition,Date,Location,Dive,Site,First Observer,Second Observer
FunDiversity,Israel,Reef Watch 2024,9/1/2024,Coral Bay,4,R2,Obs Seven,Obs Six
,,,,,,R5,Obs Seven,Obs Six
,,,,,5,R6,Obs Six,Obs Seven
"""

KNOLLS = """Project,Expedition,Country,Knoll,Date,Location,First Observer,Second Observer
EcoCamp,Camp 2023,Israel,Kappa,30.9.2023,,Obs Two,Obs One
,,,Lambda,,,Obs One,
,,,Mu,,,Obs Two,Obs One
"""

JUVENILES = """Project,Country,Expedition,Location,Date,Juveniles First Observer,Juveniles Second Observer,First Observer,Second Observer,Knoll
Juveniles Knolls,Israel,Young Fish 2024,West Bay,2/12/2024,Obs Eight,Obs Nine,Obs One,Obs Two,J4
,,,,,,,Obs One,Obs Two,J6
"""

UNSUPPORTED = """SiteID,Project,Country,Expedition,Location,Date,First Observer,Second Observer
5,Night Count,Israel,Other,Elsewhere,7/8/2022,Obs Two,Obs One
"""


@pytest.fixture(scope="module")
def plan_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("plans")
    write_csv(d, "Harbour Watch 2023/jetty.csv", TRANSECTS)
    write_csv(d, "Beach/beach.csv", BEACH)
    write_csv(d, "Reef Watch 2024/reef.csv", DIVE)
    write_csv(d, "Camp 2023/knolls.csv", KNOLLS)
    write_csv(d, "Young Fish 2024/young.csv", JUVENILES)
    write_csv(d, "Other/unsupported.csv", UNSUPPORTED)
    return str(d) + "/*/*.csv"


def test_scan_binds_by_header_and_fills(spark, plan_dir):
    df = read_deployments(spark, plan_dir)
    jetty = df.filter(F.col("file_name") == "jetty.csv")
    got = rows(jetty, "row_idx", "Location", "Date", "SiteID", "First Observer", "Second Observer")
    date = dt.date(2023, 5, 3)
    assert got == [
        (1, "South Jetty", date, "P7", "Obs Three", None),
        (2, "South Jetty", date, "P8", "Obs One", "Obs Two"),
        (3, "South Jetty", date, "P8", None, None),  # comma-only rows repeat the last id
        (4, "South Jetty", date, "P9", "Obs One", "Obs Two"),
    ]
    tlv = rows(df.filter(F.col("Project") == "TLV"), "Spot", "First Observer", "Lat", "Country", "Date")
    assert tlv == [("Kelp Wall", "Obs Five", "30 10.500", None, dt.date(2022, 2, 14)),
                   ("Pier End", "Obs Four", "30 10.500", None, dt.date(2022, 2, 14))]
    dive = rows(df.filter(F.col("Project") == "FunDiversity"), "SiteID", "Date")
    assert dive == [(site, dt.date(2024, 1, 9)) for site in ("R2", "R5", "R6")]
    assert "Dive" not in df.columns
    knolls = rows(df.filter(F.col("Project") == "EcoCamp"), "KnollID", "Location")
    assert knolls == [("Kappa", None), ("Lambda", None), ("Mu", None)]
    young = rows(df.filter(F.col("Project") == "Juveniles Knolls"), "KnollID", "Juveniles First Observer",
                 "Juveniles Second Observer")
    assert young == [("J4", "Obs Eight", "Obs Nine"), ("J6", "Obs Eight", "Obs Nine")]


def test_more_columns(spark, plan_dir, tmp_path):
    df = read_deployments(spark, plan_dir, more_columns=["Notes"]).filter(F.col("file_name") == "jetty.csv")
    assert [r["Notes"] for r in df.orderBy("row_idx").collect()] == ["calm, clear"] * 3 + ['said "go" twice']
    wide = [f"x{i}" for i in range(30)] + ["Project", "Expedition", "Location", "Date", "SiteID", "First Observer",
                                           "Second Observer", "Country"]
    values = [str(i) for i in range(30)] + ["ASSEMBLE", "E", "L", "1/2/2023", "Z", "Obs One", "Obs Two", "Israel"]
    write_csv(tmp_path, "wide.csv", ",".join(wide) + "\r\n" + ",".join(values) + "\r\n")
    got = read_deployments(spark, str(tmp_path / "wide.csv")).first()
    assert (got["SiteID"], got["Second Observer"], got["row"]["x29"], len(got["row"])) == ("Z", "Obs Two", "29", 38)


def test_checks(spark, plan_dir):
    plan = plan_from_csvs(spark, plan_dir)
    v = plan_checks(plan)
    got = rows(v.withColumn("f", F.element_at(F.split("file", "/"), -1)), "f", "check", "detail")
    assert ("unsupported.csv", "supported project", "Night Count") in got
    assert ("jetty.csv", "missing observer", "1 / 2") in got
    assert not [g for g in got if g[1].startswith("one ")]


def _emails(spark):
    return spark.createDataFrame(
        [("Obs One", "one@reef.example"), ("Obs Two", "two@reef.example"), ("Obs Four", None),
         (None, "nobody@reef.example"), ("Obs Eight", "eight@reef.example")],
        "FullName string, email string")


def test_surveyor_table_and_manifests(spark, plan_dir):
    plan = plan_from_csvs(spark, plan_dir).filter(F.col("family").isNotNull())
    out = plan_products(plan, _emails(spark))
    sv = out["surveyors"].withColumn("f", F.element_at(F.split("file", "/"), -1))
    jetty = {r["spreadsheet_name"]: (r["deployments"], r["emails"]) for r in
              sv.filter(F.col("f") == "jetty.csv").collect()}
    assert jetty["Obs One and Obs Two"] == (["P8", "P9"], ["one@reef.example", "two@reef.example"])
    # observers missing on comma-only rows form their own group; missing names
    # match the missing name in the lookup
    assert jetty["NA and NA"] == (["P8"], ["nobody@reef.example", "nobody@reef.example"])
    assert jetty["Obs Three and NA"] == (["P7"], [None, "nobody@reef.example"])
    juv = sv.filter(F.col("Project") == "Juveniles Knolls").first()
    assert juv["spreadsheet_name"] == "Obs One, Obs Two, Obs Eight, and Obs Nine"
    assert juv["deployments"] == ["J4", "J6"]
    assert juv["emails"] == ["one@reef.example", "two@reef.example", "eight@reef.example", None]

    sheets = set(r["sheet"] for r in out["worksheets"].collect())
    for name in ["Pier End - B - Invertebrates", "Pier End - A - Fish", "Site P7 - Transect D",
                 "Site R5 - Transect A - CRYPTIC", "Site R2 - Transect B - TRANSIENTS", "Knoll Kappa",
                 "Knoll J4", "Juveniles - Knoll J6"]:
        assert name in sheets, name
    pre = out["worksheets"].filter(F.col("sheet") == "Juveniles - Knoll J6").first()["prefill"]
    assert pre == ["Obs One", "Obs Two", "Obs Eight", "Obs Nine", "Knoll", "West Bay", "J6"]
    tlv_pre = out["worksheets"].filter(F.col("sheet") == "Pier End - B - Invertebrates").first()["prefill"]
    assert tlv_pre == ["Obs Four", "Obs Five", "Pier End", "B"]

    photos = out["photos"]
    assert photos.filter(F.col("folder") == "Obs One and Obs Two/P8/A").count() == 1
    assert photos.filter(F.col("spreadsheet_name").contains("Obs Four")).count() == 0  # TLV takes no photos
    access = out["access"]
    missing = access.filter(F.col("status") == "missing email").count()
    assert missing > 0
    assert access.filter((F.col("role") == "reader") & (F.col("email") == "one@reef.example")).count() >= 1


def test_deployment_form(spark):
    from reefcensus.plans.deployment import form_to_plan

    header = ["Metadata", "Value", "Site", "First Observer", "Second Observer", None]
    body = [["Project", "Bioblitz", "1", "Obs One", "Obs Two", None],
            ["Expedition", "Harbour Watch 2022", "2", "Obs Three", None, None],
            ["Location", "South Jetty", None, None, None, None],
            ["Date", "2022-03-09", None, None, None, None],
            [None, "ignored", None, None, None, None]]
    data = [("form", i, r) for i, r in enumerate([header, *body])]
    grid = spark.createDataFrame(data, "sheet string, row_idx int, cells array<string>")
    plan = form_to_plan(grid, ["sheet"], project="ASSEMBLE")
    got = rows(plan, "Country", "Project", "Expedition", "Location", "Date", "SiteID", "First Observer",
               "Second Observer")
    assert got == [
        ("Israel", "Bioblitz", "Harbour Watch 2022", "South Jetty", dt.date(2022, 3, 9), "1", "Obs One", "Obs Two"),
        ("Israel", "Bioblitz", "Harbour Watch 2022", "South Jetty", dt.date(2022, 3, 9), "2", "Obs Three", None),
    ]


def test_deployment_form_keeps_all_keys_and_cells(spark):
    from reefcensus.plans.deployment import form_to_plan

    data = [("form", i, r) for i, r in enumerate([
        ["Metadata", "Value", "Site", "First Observer", "Tide"], ["Location", "South Jetty", "1", "Obs One", "low"],
        ["Weather", "10.50", None, None, None], ["Country", None, None, None, None]])]
    grid = spark.createDataFrame(data, "sheet string, row_idx int, cells array<string>")
    got = form_to_plan(grid, ["sheet"], project="ASSEMBLE").collect()
    assert [(r["Country"], r["Project"], r["metadata"]["Weather"], r["row"]["Tide"]) for r in got] == [
        (None, "ASSEMBLE", "10.5", "low")]


def test_deployment_forms_with_conflicting_and_repeated_headings(spark):
    from reefcensus.plans.deployment import form_problems, form_to_plan

    forms = {
        "good": [["Metadata", "Value", "Site", "Notes", "Notes", "First Observer", None],
                 ["Location", "South Jetty", "1", "a", "b", "Obs One", "under a blank heading"]],
        "bad": [["Metadata", "Value", "Site", "SiteID", "First Observer"],
                ["Location", "North Jetty", "1", "2", "Obs One"]],
        "twice": [["Metadata", "Value", "Spot", "First Observer"], ["Location", "East", "Pier", "Obs One"],
                  ["Location", "West", None, None]]}
    data = [(name, i, r) for name, body in forms.items() for i, r in enumerate(body)]
    grid = spark.createDataFrame(data, "sheet string, row_idx int, cells array<string>")
    assert rows(form_problems(grid, ["sheet"]), "sheet", "check", "detail", "fatal") == [
        ("bad", "conflicting headings", "SiteID", True), ("twice", "duplicate metadata key", "Location", False)]
    got = {r["sheet"]: r for r in form_to_plan(grid, ["sheet"]).collect()}
    assert sorted(got) == ["good", "twice"]
    assert (got["good"]["SiteID"], got["good"]["row"]["Notes"]) == ("1", "a")
    assert [(c["position"], c["name"], c["value"]) for c in got["good"]["obs_cells"]] == [
        (1, "Site", "1"), (2, "Notes", "a"), (3, "Notes", "b"), (4, "First Observer", "Obs One")]
    assert got["twice"]["Location"] == "East"


BAD_PLANS = {
    "good.csv": "Project,Expedition,Location,Date,SiteID,First Observer,Second Observer,Tide,Notes,Notes,,Notes...2\n"
                "ASSEMBLE,E,L,1/2/2023,1,Obs One,Obs Two,low,a,b,c,d\n,,,,2,Obs One,,,,,,\n,,,,3,,Obs Two,high,x,,,\n",
    "conflict.csv": "Project,Expedition,Location,Date,Site,SiteID,First Observer,Second Observer\n"
                    "ASSEMBLE,E,L,1/2/2023,1,1,Obs One,Obs Two\n",
    "renamed twice.csv": "Project,Expedition,Date,Fish Observer,First Observer,Invertebrate Observer\nTLV,E,1/2/2023,a,b,c\n",
    "no observers.csv": "Project,Expedition,Location,Date,SiteID\nASSEMBLE,E,L,1/2/2023,1\n",
    "empty.csv": "",  # Spark's scan does not see a file of no bytes
    "blank lines.csv": "\n\n\n",
    "wide.csv": "Project,Date,First Observer,Second Observer\nASSEMBLE,1/2/2023,Obs One,Obs Two\n,soon,Obs One,Obs Two,more\n",
}


def test_malformed_plans_are_reported_and_the_others_read(spark, tmp_path):
    from reefcensus.plans.deployment import publish_plans
    from reefcensus.sources.deployments import read_plan_problems

    for name, text in BAD_PLANS.items():
        write_csv(tmp_path, f"plans/{name}", text)
    paths = str(tmp_path / "plans/*.csv")
    problems = read_plan_problems(spark, paths).withColumn("f", F.element_at(F.split("file", "/"), -1))
    assert rows(problems, "f", "check", "detail", "fatal") == [
        ("blank lines.csv", "empty file", None, True),
        ("conflict.csv", "conflicting headings", "SiteID", True),
        ("good.csv", "repeated headings", "Notes", False),
        ("no observers.csv", "missing heading", "First Observer, Second Observer", True),
        ("renamed twice.csv", "conflicting headings", "First Observer", True),
        ("wide.csv", "cells without heading", "first in row 2", False),
        ("wide.csv", "unreadable date", "first in row 2", False),
    ]
    plan = read_deployments(spark, paths, more_columns=["Tide"])
    assert rows(plan, "file_name", "row_idx", "SiteID", "Tide") == [
        ("good.csv", 1, "1", "low"), ("good.csv", 2, "2", "low"), ("good.csv", 3, "3", "high"),
        ("wide.csv", 1, None, None), ("wide.csv", 2, None, None)]
    good = plan.filter(F.col("file_name") == "good.csv").orderBy("row_idx").collect()
    # repeated and blank headings have a name by their place; unlisted cells fill down
    assert [r["more"].get("Notes...9") for r in good] == ["a", "a", "x"]
    assert [(r["more"].get("Notes...10"), r["more"].get("...11"), r["more"].get("Notes...12")) for r in good] == [
        ("b", "c", "d")] * 3
    assert (good[1]["row"]["Tide"], good[1]["Second Observer"], good[1]["First Observer"]) == (None, None, "Obs One")
    found = publish_plans(spark, paths, str(tmp_path / "published"), str(tmp_path / "archive"))
    checks = {(r["file"].rsplit("/", 1)[-1], r["check"]) for r in found.collect()}
    assert ("conflict.csv", "not read: conflicting headings") in checks
    assert ("good.csv", "missing observer") in checks
    kept = spark.read.parquet(str(tmp_path / "published")).select("file_name").distinct()
    assert rows(kept, "file_name") == [("good.csv",), ("wide.csv",)]

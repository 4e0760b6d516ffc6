"""Collection side on synthetic worksheets: A2, A8, A9, P6, P7, P13, P11,
P14, P15, P17, J2, J3, Q1-Q5, J6-J8, G3-G5, P19-P23."""

from __future__ import annotations

import csv
import io

import pytest
from pyspark.sql import functions as F

from reefcensus.plans.days import (
    day_tables,
    expedition_table,
    older_tlv_rows,
    sample_rows,
    sheet_violations,
    tlv_fish,
    tlv_invertebrates,
)
from reefcensus.plans.deployment import plan_from_csvs
from reefcensus.registry import FISH_LAYOUT, INVERT_LAYOUT, TLV_METADATA_KEYS
from reefcensus.sources.worksheets import read_worksheet_csvs
from tests.conftest import ordered, rows, write_csv

PAIRED_HEADER = ["Metadata", "Value", "Observer", "Species", "Amount", "Length",
                 "Observer...7", "Species...8", "Amount...9", "Length...10"]


def sheet_csv(rows_: list[list]) -> str:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    for r in rows_:
        w.writerow(["" if v is None else v for v in r])
    return buf.getvalue()


def paired_sheet(meta: list[tuple[str, str]], obs: list[list]) -> str:
    n = max(len(meta), len(obs))
    body = []
    for i in range(n):
        k, v = meta[i] if i < len(meta) else (None, None)
        o = obs[i] if i < len(obs) else [None] * 8
        body.append([k, v, *o])
    return sheet_csv([PAIRED_HEADER, *body])


PLANS = {
    "Harbour Watch 2023/jetty.csv": """Project,Expedition,Country,Location,Date,First Observer,Second Observer,SiteID,Weather
ASSEMBLE,Harbour Watch 2023,Israel,South Jetty,03/05/2023,Obs Three,,8,"calm, clear"
,,,,,Obs One,Obs Two,7,
,,,,,Obs One,Obs Two,9,windy
""",
    "Camp 2023/knolls.csv": """Project,Knoll,Expedition,Country,Date,Location,First Observer,Second Observer
EcoCamp,Kappa,Camp 2023,Israel,30.9.2023,,Obs One,Obs Two
,Lambda,,,,,Obs One,Obs Two
,Kappa,,,,,Obs One,Obs Two
""",
    "Beach/beach.csv": """Project,Spot,Lat,Lon,Location,Expedition,Date,Fish Observer,Invertebrate Observer
TLV,Pier End,,,Long Beach,Beach Series,14.2.2022,Obs Four,Obs Five
""",
}


def invert_sheet() -> str:
    """14 columns, 35 data rows: metadata 1-14, legend 17-35, four quadrats."""
    grid = [[None] * 14 for _ in range(35)]
    meta = dict(zip(TLV_METADATA_KEYS, ["Obs Four", "Obs Five", "Pier End", "A", "Jaffa", "Rock",
                                        "10.50", "12.0", "10:30", "11:00", "8", "L1", "P1", "note"]))
    for i, k in enumerate(TLV_METADATA_KEYS):
        grid[i][0], grid[i][1] = k, meta[k]
    legend = [("S", "Sand"), ("R", "Rock"), ("B", "Bivalvia"), (None, None), ("C", "CCA Algae")]
    for i, (c, v) in enumerate(legend):
        grid[16 + i][0], grid[16 + i][1] = c, v
    q1 = ["S"] * 8 + ["R"] * 4 + ["X", "X", None, None]   # 50 / 25, unknown drop, blanks hit blank legend row
    q2 = [None] * 16                                       # only blank codes: survives with zeros
    q3 = ["X"] * 16                                        # unknown codes only: vanishes
    q4 = ["B"] * 16                                        # 100 Bivalvia
    for p in range(16):
        top, bottom = p, 18 + p
        grid[top][3:6] = [str(p + 1), q1[p], "Caulerpa" if p == 0 else None]
        grid[top][9:12] = [str(p + 1), q2[p], None]
        grid[bottom][3:6] = [str(p + 1), q3[p], None]
        grid[bottom][9:12] = [str(p + 1), q4[p], "Pinna" if p == 1 else None]
    grid[0][6:8] = ["Hermodice", "3"]
    grid[18][12:14] = ["Arbacia", "x"]
    grid[2][2], grid[2][8], grid[20][2], grid[20][8] = "2", "3", "1", "4"   # complexity cells
    header = ["Metadata", "Value"] + [f"c{i}" for i in range(3, 15)]
    return sheet_csv([header, *grid])


@pytest.fixture(scope="module")
def survey(spark, tmp_path_factory):
    return build_survey(spark, tmp_path_factory.mktemp("drive"))


def build_survey(spark, root):
    plans = root / "plans"
    for name, text in PLANS.items():
        write_csv(plans, name, text)
    sheets = root / "sheets"
    jetty = "Harbour Watch 2023/South Jetty 2023-05-03"
    obs1 = [["Obs One", "Sparisoma", "3", "10", "Obs Two", "Diplodus", "2", "12"],
            ["Obs One", "Epinephelus", None, "20", "Obs Two", "Mullus", "1", "8"]]  # half-filled row
    write_csv(sheets, f"{jetty}/Obs One and Obs Two/Site 7 - Transect A.csv",
              paired_sheet([("First Observer", "Obs One"), ("Second Observer", "Obs Two"), ("Site", "7"),
                            ("Transect", "A"), ("Depth Start", "10.50")], obs1))
    write_csv(sheets, f"{jetty}/Obs One and Obs Two/Site 9 - Transect A.csv",
              paired_sheet([("First Observer", "Obs One"), ("Second Observer", "Obs Two"), ("Site", "9")], []))
    write_csv(sheets, f"{jetty}/Obs One and Obs Two/Species List.csv",
              paired_sheet([("First Observer", "x")], [["a", "b", "1", "1", "c", "d", "1", "1"]]))
    write_csv(sheets, f"{jetty}/Obs Three and NA/Site 8 - Transect A.csv",
              paired_sheet([("First Observer", "Obs Three"), ("Second Observer", None), ("Site", "008")],
                           [["Obs Three", "Thalassoma", "5", "7", None, None, None, None]]))
    write_csv(sheets, f"{jetty}/Metadata/metadata.csv",
              paired_sheet([("First Observer", "Obs One")], [["a", "b", "1", "1", "c", "d", "1", "1"]]))
    camp = "Camp 2023/NA 2023-09-30"
    for knoll, fish in [("Lambda", "Chromis"), ("Kappa", "Pseudanthias")]:
        write_csv(sheets, f"{camp}/Obs One and Obs Two/Knoll {knoll}.csv",
                  paired_sheet([("First Observer", "Obs One"), ("Second Observer", "Obs Two"), ("Knoll", knoll)],
                               [["Obs One", fish, "4", "5", "Obs Two", fish, "6", "5"]]))
    # a sheet with no plan row (dropped silently) and a template sheet with no
    # observations (no effect)
    write_csv(sheets, f"{camp}/Obs One and Obs Two/Knoll Gamma.csv",
              paired_sheet([("First Observer", "Obs One"), ("Second Observer", "Obs Two"), ("Knoll", "Gamma")],
                           [["Obs One", "Chromis", "9", "5", None, None, None, None]]))
    write_csv(sheets, f"{camp}/Obs One and Obs Two/Observer Table - MASTER.csv",
              paired_sheet([("First Observer", None), ("Second Observer", None)], []))
    tlv = "Beach Series/Long Beach 2022-02-14/Obs Four and Obs Five"
    fish_header = ["Metadata", "Value", "Species", "Amount", "Length", "Distance", "Confidence"]
    fish_meta = [("Fish Observer", "Obs Four"), ("Invertebrate Observer", "Obs Five"), ("Site", "Pier End"),
                 ("Transect", "A"), ("Segment", "Jaffa"), ("Depth Start", "10.50")]
    fish_obs = [["Sparisoma cretense", "2", "10", "1", "high"], ["Unknown fish", "1", "5", "2", None],
                ["Siganus", "3", None, "2", None]]
    body = [[*(fish_meta[i] if i < len(fish_meta) else (None, None)), *(fish_obs[i] if i < len(fish_obs) else [None] * 5)]
            for i in range(max(len(fish_meta), len(fish_obs)))]
    write_csv(sheets, f"{tlv}/Pier End - A - Fish.csv", sheet_csv([fish_header, *body]))
    write_csv(sheets, f"{tlv}/Pier End - A - Invertebrates.csv", invert_sheet())
    plan = plan_from_csvs(spark, str(plans) + "/*/*.csv")
    grid = read_worksheet_csvs(spark, str(sheets))
    return plan, grid


def test_sample_rows_and_keys(spark, survey):
    plan, grid = survey
    s = sample_rows(grid, plan).filter(F.col("expedition") == "Harbour Watch 2023")
    got = rows(s, "sheet", "observer_half", "Species", "meta_to_deployment_id", "Depth Start")
    assert got == [
        ("Site 7 - Transect A", 1, "Sparisoma", "Obs One and Obs Two - 7", "10.5"),
        ("Site 7 - Transect A", 2, "Diplodus", "Obs One and Obs Two - 7", "10.5"),
        ("Site 7 - Transect A", 2, "Mullus", "Obs One and Obs Two - 7", "10.5"),
        ("Site 8 - Transect A", 1, "Thalassoma", "Obs Three and NA - 8", None),
    ]


def test_day_tables_report_and_skip_mismatching_days(spark, survey):
    plan, grid = survey
    complete, bad = day_tables(plan, sample_rows(grid, plan))
    assert rows(bad, "day_folder", "meta_to_deployment_id") == [
        ("South Jetty 2023-05-03", "Obs One and Obs Two - 9")]
    days = {r["day_folder"] for r in complete.select("day_folder").distinct().collect()}
    assert days == {"NA 2023-09-30", "Long Beach 2022-02-14"}
    camp = complete.filter(F.col("day_folder") == "NA 2023-09-30")
    # the repeated Kappa plan row fans out; the unplanned Gamma sheet adds nothing
    assert rows(camp, "KnollID", "Species", "Amount") == ordered([
        ("Kappa", "Pseudanthias", "4"), ("Kappa", "Pseudanthias", "6"),
        ("Kappa", "Pseudanthias", "4"), ("Kappa", "Pseudanthias", "6"),
        ("Lambda", "Chromis", "4"), ("Lambda", "Chromis", "6")])
    assert "First Observer.x" in complete.columns and "First Observer.y" in complete.columns


def add_unreadable(root):
    """A sheet with an odd width and one that repeats a key, in the knoll day."""
    camp = "Camp 2023/NA 2023-09-30/Obs One and Obs Two"
    write_csv(root / "sheets", f"{camp}/Knoll Odd.csv",
              sheet_csv([PAIRED_HEADER[:-1], ["Knoll", "Odd"] + ["x"] * 7]))
    write_csv(root / "sheets", f"{camp}/Knoll Twice.csv", paired_sheet([("Knoll", "Lambda"), ("Knoll", "Kappa")], []))


def test_unreadable_sheets_hold_their_day_back(spark, tmp_path):
    build_survey(spark, tmp_path)
    add_unreadable(tmp_path)
    plan, grid = plan_from_csvs(spark, str(tmp_path / "plans") + "/*/*.csv"), read_worksheet_csvs(
        spark, str(tmp_path / "sheets"))
    assert sorted((r["sheet"], r["check"]) for r in sheet_violations(grid, plan).collect()) == [
        ("Knoll Odd", "odd observer columns"), ("Knoll Twice", "duplicate metadata key")]
    complete, bad = expedition_table(plan, grid)
    assert {r["day_folder"] for r in complete.collect()} == {"Long Beach 2022-02-14"}
    assert rows(bad, "day_folder", "meta_to_deployment_id", "check") == [
        ("NA 2023-09-30", "Obs One and Obs Two/Knoll Odd", "odd observer columns"),
        ("NA 2023-09-30", "Obs One and Obs Two/Knoll Twice", "duplicate metadata key"),
        ("South Jetty 2023-05-03", "Obs One and Obs Two - 9", "mismatching identifier")]


def test_wide_sheets_and_quotes_are_read_whole(spark, tmp_path):
    wide = [f"c{i}" for i in range(70)]
    text = sheet_csv([["Metadata", "Value", *wide], ["Notes", 'He said ""hi"", ok', *[str(i) for i in range(70)]]])
    text = text.replace('""""', '""') + '"two\nlines, one cell" , x,"a""b"\n,,\n\n'
    write_csv(tmp_path, "E/D/S/T.csv", text)
    got = read_worksheet_csvs(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [len(r["cells"]) for r in got] == [72, 72, 3, 3]
    assert got[1]["cells"][71] == "69" and got[2]["cells"] == ["two\nlines, one cell", "x", 'a"b']
    assert got[3]["cells"] == [None] * 3 and [r["row_idx"] for r in got] == [0, 1, 2, 3]


def test_all_metadata_keys_are_kept(spark, survey):
    plan, grid = survey
    extra = grid.filter(F.col("sheet") == "Site 7 - Transect A").filter(F.col("row_idx") == 1).select(
        *[c for c in grid.columns if c not in ("row_idx", "cells")], F.lit(90).alias("row_idx"),
        F.array(F.lit("Weather"), F.lit("10.50")).alias("cells"))
    got = sample_rows(grid.unionByName(extra), plan).filter(F.col("sheet") == "Site 7 - Transect A").first()
    assert got["metadata"]["Weather"] == "10.5" and got["metadata"]["Transect"] == got["Transect"] == "A"


def test_tlv_fish_layout(spark, survey):
    plan, grid = survey
    traits = spark.createDataFrame([("Sparisoma cretense", 0.01, 3.0, "LC")],
                                   "Species string, a double, b double, IUCN string")
    fish, early = tlv_fish(plan, grid, traits)
    assert early.count() == 0
    assert fish.columns == [n for n, _ in FISH_LAYOUT]
    got = rows(fish, "Species", "Site", "Site_number", "Season", "weight_kg", "Survey_id", "Depth Start")
    assert got == [
        ("Sparisoma cretense", "Jaffa", 12, "Winter", pytest.approx(2 * 0.01 * 10 ** 3 / 1000),
         "Obs Four and Obs Five - Pier End_2022-02-14", "10.5"),
        ("Unknown fish", "Jaffa", 12, "Winter", None, "Obs Four and Obs Five - Pier End_2022-02-14", "10.5"),
    ]


def test_tlv_invertebrate_layout(spark, survey):
    plan, grid = survey
    inv, early = tlv_invertebrates(plan, grid)
    assert early.count() == 0
    assert inv.columns == [n for n, _ in INVERT_LAYOUT]
    got = rows(inv, "Quadrate_number", "Complexity", "Sand", "Rock", "Bivalvia", "Taxon", "Count", "1", "2")
    assert got == [
        (1, 2.0, 50.0, 25.0, 0.0, "Hermodice", 3.0, "Caulerpa", None),
        (2, 3.0, 0.0, 0.0, 0.0, None, None, None, None),
        (4, 4.0, 0.0, 0.0, 100.0, "Arbacia", None, None, "Pinna"),
    ]
    q = inv.filter(F.col("Quadrate_number") == 1).first()
    assert q["Quadrate_id"] == "Obs Four and Obs Five - Pier End_2022-02-14_A 1"
    assert q["Method"] == "Quadrate" and q["Depth_Start"] == "10.5" and q["Site_number"] == 12


def test_older_tlv_layout(spark, tmp_path):
    plans = tmp_path / "plans"
    write_csv(plans, "Beach/old_beach.csv",
              "Spot,Project,Expedition,Location,Date,Fish Observer,Invertebrate Observer\n"
              "Pier End,TLV,Beach Series,Long Beach,5.8.2020,Obs Four,Obs Five\n")
    sheets = tmp_path / "sheets"
    day = "Beach Series/Long Beach 2020-08-05/Obs Four and Obs Five"
    meta = [("Fish Observer", "Obs Four"), ("Invertebrate Observer", "Obs Five"), ("Site", "Pier End"),
            ("Transect", "A")]
    fish = [["Metadata", "Value", "Species", "Amount", "Length", "Distance"],
            *[[k, v, *o] for (k, v), o in zip(meta + [("Time Start", "09:30"), ("Depth Start", "6.0")],
                                               [["Diplodus", "2", "10", "1"], ["Mullus", "1", "8", "2"],
                                                [None] * 4, [None] * 4, [None] * 4, [None] * 4])]]
    inv = [["Metadata", "Value", "Invertebrate|Taxon", "Abundance", "Quadrate"],
           *[[k, v, *o] for (k, v), o in zip(meta, [["Hermodice", "3", "1"], ["Arbacia", "2", "2"],
                                                    [None] * 3, [None] * 3])]]
    quad = [["Metadata", "Value", "Quadrate", "Sand", "Rock"],
            *[[k, v, *o] for (k, v), o in zip(meta, [["1", "50", None], ["2", None, "25"], [None, "9", "9"],
                                                     [None] * 3])]]
    write_csv(sheets, f"{day}/Pier End - A - Fish.csv", sheet_csv(fish))
    write_csv(sheets, f"{day}/Pier End - A - Invertebrates.csv", sheet_csv(inv))
    write_csv(sheets, f"{day}/Quadrate data.csv", sheet_csv(quad))
    plan = plan_from_csvs(spark, str(plans) + "/*/*.csv")
    grid = read_worksheet_csvs(spark, str(sheets))
    out = older_tlv_rows(grid, plan)
    got = rows(out, "Group", "Species", "Invertebrate|Taxon", "Quadrate", "Time Start", "Depth Start",
               "quadrat_data", "meta_to_deployment_id")
    key = "Obs Four and Obs Five - Pier End"
    assert got == [
        ("Fish", "Diplodus", None, None, "09:30", "6", None, key),
        ("Fish", "Mullus", None, None, "09:30", "6", None, key),
        ("Invertebrates", None, "Arbacia", "2", "09:30", "6", {"Quadrate": "2", "Sand": "0", "Rock": "25"}, key),
        ("Invertebrates", None, "Hermodice", "1", "09:30", "6", {"Quadrate": "1", "Sand": "50", "Rock": "0"}, key),
    ]


def test_strict_day_build_stops_on_mismatch(spark, survey):
    from reefcensus.operators.checks import SurveyCheckError

    plan, grid = survey
    with pytest.raises(SurveyCheckError, match="mismatching identifiers"):
        day_tables(plan, sample_rows(grid, plan), strict=True)
    ok_plan = plan.filter(F.col("day_folder") != "South Jetty 2023-05-03")
    complete, bad = day_tables(ok_plan, sample_rows(grid, ok_plan), strict=True)
    assert bad.count() == 0 and complete.count() > 0


def test_sheet_names_keep_plus_and_spaces(spark, tmp_path):
    write_csv(tmp_path, "Exp A/Day 1/Obs One + Obs Two/Site 1 + 2 - 50%.csv", sheet_csv([["Metadata", "Value"]]))
    g = read_worksheet_csvs(spark, str(tmp_path))
    assert rows(g, "expedition", "day_folder", "spreadsheet", "sheet") == [
        ("Exp A", "Day 1", "Obs One + Obs Two", "Site 1 + 2 - 50%")]


def test_invertebrate_sheets_keep_all_metadata_keys(spark, survey):
    from reefcensus.operators.cover import invertebrate_sheets
    from reefcensus.operators.grid import SHEET_KEYS

    grid = survey[1].filter(F.col("sheet") == "Pier End - A - Invertebrates")
    last = F.lit(TLV_METADATA_KEYS[-1])
    cells = F.when(F.try_element_at("cells", F.lit(1)) == last, F.concat(
        F.array(F.lit("Weather"), F.lit("10.50")), F.slice("cells", 3, 1000))).otherwise(F.col("cells"))
    out = invertebrate_sheets(grid.withColumn("cells", cells), SHEET_KEYS, TLV_METADATA_KEYS)
    got = out.select("metadata", "Transect").collect()
    assert got and all(r["metadata"]["Weather"] == "10.5" and r["metadata"]["Transect"] == r["Transect"] == "A"
                       for r in got)


def test_older_rows_keep_all_keys_and_fields(spark, tmp_path):
    write_csv(tmp_path / "plans", "Beach/old_beach.csv",
              "Spot,Project,Expedition,Location,Date,Fish Observer,Invertebrate Observer\n"
              "Pier End,TLV,Beach Series,Long Beach,5.8.2020,Obs Four,Obs Five\n")
    meta = [("Fish Observer", "Obs Four"), ("Invertebrate Observer", "Obs Five"), ("Site", "Pier End"),
            ("Transect", "A"), ("Weather", "10.50")]
    inv = [["Metadata", "Value", "Invertebrate|Taxon", "Abundance", "Quadrate", "Colour"],
           *[[k, v, *o] for (k, v), o in zip(meta, [["Hermodice", "3", "1", "red"], *[[None] * 4] * 4])]]
    quad = [["Metadata", "Value", "Quadrate", "Sand"],
            *[[k, v, *o] for (k, v), o in zip(meta, [["1", "50"], *[[None] * 2] * 4])]]
    day = "sheets/Beach Series/Long Beach 2020-08-05/Obs Four and Obs Five"
    write_csv(tmp_path, f"{day}/Pier End - A - Invertebrates.csv", sheet_csv(inv))
    write_csv(tmp_path, f"{day}/Quadrate data.csv", sheet_csv(quad))
    out = older_tlv_rows(read_worksheet_csvs(spark, str(tmp_path / "sheets")),
                         plan_from_csvs(spark, str(tmp_path) + "/plans/*/*.csv")).collect()
    assert [(r["metadata"]["Weather"], r["quadrat_metadata"]["Weather"], r["obs"]["Colour"], r["quadrat_data"]["Sand"])
            for r in out] == [("10.5", "10.5", "red", "50")]


def test_tab_order_decides_the_fill(spark, tmp_path):
    """The second sheet by name is the first tab, so its times fill the other."""
    write_csv(tmp_path / "plans", "Beach/old_beach.csv",
              "Spot,Project,Expedition,Location,Date,Fish Observer,Invertebrate Observer\n"
              "Pier End,TLV,Beach Series,Long Beach,5.8.2020,Obs Four,Obs Five\n")
    meta = [("Fish Observer", "Obs Four"), ("Invertebrate Observer", "Obs Five"), ("Site", "Pier End"), ("Transect", "A")]

    def fish(times, species):
        keys = meta + times
        obs = [[s, "1", "10", "1"] for s in species] + [[None] * 4] * (len(keys) - len(species))
        return sheet_csv([["Metadata", "Value", "Species", "Amount", "Length", "Distance"],
                          *[[k, v, *o] for (k, v), o in zip(keys, obs)]])

    day = "Beach Series/Long Beach 2020-08-05"
    for pair in ("listed", "not listed"):
        at = f"sheets/{day}/{pair}"
        write_csv(tmp_path, f"{at}/A Fish.csv", fish([], ["Diplodus", "Mullus"]))
        write_csv(tmp_path, f"{at}/B Fish.csv", fish([("Time Start", "09:30")], ["Sparisoma"]))
        write_csv(tmp_path, f"{at}/C Fish.csv", fish([("Time Start", "11:00")], ["Siganus"]))
    write_csv(tmp_path, f"sheets/{day}/listed/sheet order.csv", "sheet\nC Fish\nA Fish\nB Fish\n")
    grid = read_worksheet_csvs(spark, str(tmp_path / "sheets"))
    out = older_tlv_rows(grid, plan_from_csvs(spark, str(tmp_path) + "/plans/*/*.csv"))
    assert rows(out, "spreadsheet", "Species", "Time Start") == ordered([
        ("listed", "Siganus", "11:00"), ("listed", "Diplodus", "11:00"), ("listed", "Mullus", "11:00"),
        ("listed", "Sparisoma", "09:30"), ("not listed", "Diplodus", None), ("not listed", "Mullus", None),
        ("not listed", "Sparisoma", "09:30"), ("not listed", "Siganus", "11:00")])
    from reefcensus.operators.grid import sheet_offsets
    got = rows(sheet_offsets(grid).filter("spreadsheet = 'listed'"), "sheet", "sheet_no", "offset")
    assert got == [("A Fish", 1, 6), ("B Fish", 2, 11), ("C Fish", 0, 0)]


def test_day_build_scans_the_grid_once(spark, survey, tmp_path):
    from reefcensus.plans.days import build_days
    from reefcensus.sources.worksheets import read_grid, write_grid

    plan, grid = survey
    write_grid(grid, str(tmp_path / "grid"))
    complete, bad = build_days(plan, read_grid(spark, str(tmp_path / "grid")))
    assert not [f for df in (complete, bad) for f in df.inputFiles() if str(tmp_path) in f and "/grid/" in f]
    assert {r["day_folder"] for r in complete.collect()} == {"NA 2023-09-30", "Long Beach 2022-02-14"}
    # the mismatch check reads no observation cells
    plan_text = bad._jdf.queryExecution().executedPlan().toString()
    assert "obs:map" not in plan_text and "obs_cells:array" not in plan_text


def test_tlv_groups_are_stored_and_read_back(spark, survey, tmp_path):
    from reefcensus.plans.days import build_tlv, read_tlv_group

    plan, grid = survey
    traits = spark.createDataFrame([("Sparisoma cretense", 0.01, 3.0, "LC", "from traits", "x")],
                                   "Species string, a double, b double, IUCN string, Notes string, `1` string")
    path = str(tmp_path / "complete")
    early = build_tlv(spark, plan, grid, traits, path)
    assert early.count() == 0
    for _ in range(2):  # building again replaces the groups
        fish, inverts = (read_tlv_group(spark, path, g) for g in ("Fish", "Invertebrates"))
        assert fish.columns == ["expedition", "day_folder", *[n for n, _ in FISH_LAYOUT]]
        assert inverts.columns == ["expedition", "day_folder", *[n for n, _ in INVERT_LAYOUT]]
        assert rows(fish, "expedition", "day_folder", "Group", "Species") == [
            ("Beach Series", "Long Beach 2022-02-14", "Fish", s) for s in ("Sparisoma cretense", "Unknown fish")]
        assert rows(inverts, "day_folder", "Group", "Quadrate_number", "Taxon") == [
            ("Long Beach 2022-02-14", "Invertebrates", 1, "Hermodice"), ("Long Beach 2022-02-14", "Invertebrates", 2, None),
            ("Long Beach 2022-02-14", "Invertebrates", 4, "Arbacia")]
        # a column that the traits have too is the sheet's
        assert {r["Notes"] for r in fish.collect()} == {None} and {r["1"] for r in fish.collect()} == {None}
        build_tlv(spark, plan, grid, traits, path)
    assert sorted(p.name for p in (tmp_path / "complete" / "expedition=Beach Series").glob("*/*")) == [
        "Group=Fish", "Group=Invertebrates"]


def test_expected_and_arrived_sheets(spark, survey):
    from reefcensus.plans.days import arrived_check

    plan, grid = survey
    # a sheet that came in twice, and one without observations
    twice = grid.filter(F.col("sheet") == "Knoll Lambda")
    got = arrived_check(plan, grid.unionByName(twice)).filter("expedition <> 'Beach Series'")
    found = rows(got, "spreadsheet", "sheet", "expected", "arrived", "status")
    pair = "Obs One and Obs Two"
    assert ("Obs Three and NA", "Site 8 - Transect A", 1, 1, "ok") in found
    assert ("Obs Three and NA", "Site 8 - Transect B", 1, 0, "missing") in found
    assert (pair, "Knoll Gamma", 0, 1, "unexpected") in found
    assert (pair, "Knoll Kappa", 2, 1, "duplicate") in found  # planned twice under one name
    assert (pair, "Knoll Lambda", 1, 2, "duplicate") in found
    assert (pair, "Site 9 - Transect A", 1, 1, "empty") in found
    assert (pair, "Observer Table - MASTER", 0, 1, "unexpected") in found
    assert not [f for f in found if f[1] in ("Species List", "metadata")]
    assert sum(f[4] == "missing" for f in found) == 3 * 4 - 3


def test_blank_and_repeated_headings_keep_their_cells(spark):
    from reefcensus.operators.grid import observer_rows

    sheet = [["Metadata", "Value", "Species", "Notes", None, "Notes...6", "Species...7", "Notes...8", None, "Notes...10"],
             [None, None, "Diplodus", "a", "b", "c", "Mullus", "d", "e", "f"],
             [None, None, None, "x", None, None, None, None, None, None]]
    data = [("s", i, r) for i, r in enumerate(sheet)]
    df = spark.createDataFrame(data, "sheet string, row_idx int, cells array<string>")
    want = [(1, [(1, "Species", "Diplodus"), (2, "Notes", "a"), (3, None, "b"), (4, "Notes", "c")]),
            (2, [(1, "Species", "Mullus"), (2, "Notes", "d"), (3, None, "e"), (4, "Notes", "f")])]
    for header in (None, sheet[0]):
        got = observer_rows(df, ["sheet"], header=header).orderBy("observer_half").collect()
        assert [(r["observer_half"], [tuple(c) for c in r["obs_cells"]]) for r in got] == want
        assert [r["obs"] for r in got] == [{"Species": "Diplodus", "Notes": "a"}, {"Species": "Mullus", "Notes": "d"}]
    # a known layout without columns gives no rows of the same schema
    none = observer_rows(df, ["sheet"], header=["Metadata", "Value"])
    assert none.count() == 0 and none.schema == observer_rows(df, ["sheet"], header=sheet[0]).schema


def test_sheet_blocks_with_absent_and_repeated_rows(spark):
    from reefcensus.operators.cover import invertebrate_sheets
    from reefcensus.operators.grid import cover_points, legend, quadrat_counts, sheet_arrays

    body = list(csv.reader(io.StringIO(invert_sheet())))
    data = [("whole", i, [c or None for c in r]) for i, r in enumerate(body)]
    data += [("twice", *r[1:]) for r in data] * 2
    data += [("short", *r[1:]) for r in data[:20]] + [("header only", 0, ["Metadata"])]
    df = spark.createDataFrame(data, "sheet string, row_idx int, cells array<string>")
    sheets = sheet_arrays(df, ["sheet"])
    assert {r["sheet"]: len(r["rows"]) for r in sheets.collect()} == dict.fromkeys(
        ("whole", "twice", "short", "header only"), 35)
    assert cover_points(sheets, ["sheet"]).count() == 4 * 64 and legend(sheets, ["sheet"]).count() == 4 * 19
    assert rows(quadrat_counts(sheets, ["sheet"]), "sheet", "Quadrate", "Taxon", "Count") == [
        ("short", 1, "Hermodice", 3.0), ("short", 4, "Arbacia", None), ("twice", 1, "Hermodice", 3.0),
        ("twice", 4, "Arbacia", None), ("whole", 1, "Hermodice", 3.0), ("whole", 4, "Arbacia", None)]
    out = invertebrate_sheets(df, ["sheet"], TLV_METADATA_KEYS)
    assert rows(out, "sheet", "Quadrate", "Sand") == [
        ("short", 1, 50.0), ("short", 2, 0.0), ("short", 3, 0.0), ("short", 4, 0.0), ("twice", 1, 50.0), ("twice", 2, 0.0),
        ("twice", 4, 0.0), ("whole", 1, 50.0), ("whole", 2, 0.0), ("whole", 4, 0.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "Join" not in final

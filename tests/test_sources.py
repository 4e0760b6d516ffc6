"""A8 / A9 pruning with survey names."""

from __future__ import annotations

from reefcensus.registry import INVERTEBRATE_SHEET_EXCLUDE, OLDER_QUADRAT_SHEET, OLDER_SHEET_EXCLUDE
from reefcensus.sources.lookups import prune_sheets, prune_sources
from tests.conftest import rows

SOURCES = ["Obs One and Obs Two", "Metadata", "Photos", "COMPLETE DATA", "Obs Three and NA"]
SHEETS = ["Site 1 - Transect A", "Blue Spot - A - Invertebrates", "Blue Spot - A - Fish", "Species List",
          "Readme.txt", "Readme-txt", "Quadrate data", "Observer Table - MASTER"]


def test_prune_sources(spark):
    df = spark.createDataFrame([(s,) for s in SOURCES], "spreadsheet string")
    assert rows(prune_sources(df), "spreadsheet") == [("Obs One and Obs Two",), ("Obs Three and NA",)]
    assert rows(prune_sources(df, names=["Photos", "Obs Three and NA"]), "spreadsheet") == [
        ("Obs Three and NA",), ("Photos",)]


def test_prune_sheets(spark):
    df = spark.createDataFrame([(s,) for s in SHEETS], "sheet string")
    fish = [r[0] for r in rows(prune_sheets(df), "sheet")]
    # patterns are regular expressions: the dot in "Readme.txt" matches any character
    assert fish == ["Blue Spot - A - Fish", "Observer Table - MASTER", "Site 1 - Transect A"]
    inv = [r[0] for r in rows(prune_sheets(df, exclude=INVERTEBRATE_SHEET_EXCLUDE), "sheet")]
    assert inv == ["Blue Spot - A - Invertebrates", "Observer Table - MASTER", "Site 1 - Transect A"]
    older = [r[0] for r in rows(prune_sheets(df, exclude=OLDER_SHEET_EXCLUDE), "sheet")]
    assert "Blue Spot - A - Fish" in older and "Blue Spot - A - Invertebrates" in older
    assert [r[0] for r in rows(prune_sheets(df, include=OLDER_QUADRAT_SHEET), "sheet")] == ["Quadrate data"]


def test_records_of_odd_texts(spark):
    from reefcensus.sources.deployments import csv_records

    many = ",".join(str(i) for i in range(20_000))
    quotes = '"' + 'a""b,' * 20_000 + '"'
    texts = {
        "last field quoted": 'a,"b, c\nd"\r\n"e"\n', "quotes inside plain": 'a"b,c "d" e,"f"g,\n', "open quote": 'a,"b\nc,d',
        "only blank": " \n\t\n", "no line end": "x,y", "bom": "\ufeffx", "many": many + "\n" + many, "quotes": quotes,
        "carriage returns": "a\rb\r\rc"}
    df = spark.createDataFrame([(k, k, t) for k, t in texts.items()], "file string, file_name string, value string")
    got = {}
    for r in csv_records(df).orderBy("file", "row_idx").collect():
        got.setdefault(r["file"], []).append(r["cells"])
    assert got["last field quoted"] == [["a", "b, c\nd"], ["e"]]
    assert got["quotes inside plain"] == [['a"b', 'c "d" e', '"f"g', None]]
    assert got["open quote"] == [["a", '"b'], ["c", "d"]]
    assert got["only blank"] == [[None], [None]] and got["no line end"] == [["x", "y"]] and got["bom"] == [["x"]]
    assert [len(r) for r in got["many"]] == [20_000] * 2 and got["many"][1][19_999] == "19999"
    assert got["quotes"] == [['a"b,' * 20_000]]
    assert got["carriage returns"] == [["a"], ["b"], ["c"]]

"""Sinks (K1-K5), stored days (A6, A7, I1-I3) and the streaming day build."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from reefcensus.operators.complete import complete_days, join_days
from reefcensus.plans.days import expedition_table, sample_rows, day_tables
from reefcensus.sinks import archive_deployments, publish_metadata, write_backup, write_day_complete, write_expedition
from reefcensus.sources.lookups import read_complete_days, read_published_metadata
from reefcensus.streaming.worksheet_stream import start_day_builds
from tests.conftest import rows, write_csv
from tests.test_days import build_survey, paired_sheet


def test_sinks_and_incremental_days(spark, tmp_path):
    plan, grid = build_survey(spark, tmp_path / "drive")
    out = tmp_path / "out"
    publish_metadata(plan, str(out / "metadata"))
    meta = read_published_metadata(spark, str(out / "metadata"))
    assert meta.count() == plan.count()
    assert read_published_metadata(spark, str(out / "metadata"), expedition="Camp 2023").count() == 3

    complete, bad = day_tables(meta, sample_rows(grid, meta))
    write_day_complete(complete, str(out / "complete"))
    stored = read_complete_days(spark, str(out / "complete"))
    days = rows(complete_days(stored), "expedition", "day_folder")
    assert days == [("Beach Series", "Long Beach 2022-02-14"), ("Camp 2023", "NA 2023-09-30")]
    assert join_days(stored, "Camp 2023").count() == 6  # Kappa is planned twice

    # Only days without a stored table are rebuilt (here: the South Jetty day,
    # which still mismatches), stored days are stacked unchanged
    exp, bad2 = expedition_table(meta, grid, stored)
    assert rows(bad2.select("day_folder").distinct(), "day_folder") == [("South Jetty 2023-05-03",)]
    assert exp.count() == stored.count()

    write_expedition(exp, str(out / "expedition"))
    assert spark.read.parquet(str(out / "expedition")).count() == exp.count()
    folder = write_backup(exp.drop("obs", "metadata", "row"), str(out / "backups"), "Camp 2023")
    back = spark.read.option("header", True).csv(folder)
    assert back.select("Flag").distinct().first()["Flag"].startswith("This is a local backup")
    archive_deployments(plan.drop("family", "row"), str(out / "archive"))
    assert any(p.startswith("Expedition=") for p in os.listdir(out / "archive"))

    # dynamic overwrite: rewriting one day leaves the other days in place
    write_day_complete(complete.filter(F.col("expedition") == "Camp 2023"), str(out / "complete"))
    assert read_complete_days(spark, str(out / "complete")).count() == complete.count()


def test_streaming_day_builds(spark, tmp_path):
    plan, _ = build_survey(spark, tmp_path / "drive")
    out = tmp_path / "out"
    publish_metadata(plan, str(out / "metadata"))
    sheets = str(tmp_path / "drive" / "sheets")
    q = start_day_builds(spark, sheets, str(out / "metadata"), str(out / "grid"), str(out / "complete"),
                         str(out / "mismatch"), name=f"t{os.getpid()}")
    q.awaitTermination(300)
    done = spark.read.parquet(str(out / "complete"))
    assert rows(done.select("day_folder").distinct(), "day_folder") == [
        ("Long Beach 2022-02-14",), ("NA 2023-09-30",)]
    status = spark.read.parquet(str(out / "mismatch"))
    assert status.filter(F.col("check") != "ok").count() == 1
    assert status.filter(F.col("check") == "ok").count() == 2
    # a second run with no new files has nothing to do
    q2 = start_day_builds(spark, sheets, str(out / "metadata"), str(out / "grid"), str(out / "complete"),
                          str(out / "mismatch"), name=f"t{os.getpid()}")
    q2.awaitTermination(300)
    assert spark.read.parquet(str(out / "complete")).count() == done.count()
    # the missing sheet of the mismatching day arrives: only that day is
    # rebuilt, from its old and new sheets together
    write_csv(tmp_path / "drive" / "sheets", "Harbour Watch 2023/South Jetty 2023-05-03/Obs One and Obs Two/"
              "Site 9 - Transect B.csv",
              paired_sheet([("First Observer", "Obs One"), ("Second Observer", "Obs Two"), ("Site", "9")],
                           [["Obs One", "Serranus", "1", "9", None, None, None, None]]))
    q3 = start_day_builds(spark, sheets, str(out / "metadata"), str(out / "grid"), str(out / "complete"),
                          str(out / "mismatch"), name=f"t{os.getpid()}")
    q3.awaitTermination(300)
    after = spark.read.parquet(str(out / "complete"))
    north = after.filter(F.col("day_folder") == "South Jetty 2023-05-03")
    assert sorted(r["Species"] for r in north.collect()) == ["Diplodus", "Mullus", "Serranus", "Sparisoma",
                                                             "Thalassoma"]
    assert after.filter(F.col("day_folder") != "South Jetty 2023-05-03").count() == done.count()
    mism = spark.read.parquet(str(out / "mismatch"))
    assert rows(mism.filter(F.col("day_folder") == "South Jetty 2023-05-03"), "check") == [("ok",)]


def test_ingest_and_publish(spark, tmp_path):
    from reefcensus.plans.days import ingest_worksheets
    from reefcensus.plans.deployment import publish_plans
    from reefcensus.sources.worksheets import read_worksheet_csvs

    build_survey(spark, tmp_path / "drive")
    sheets = str(tmp_path / "drive" / "sheets")
    grid = ingest_worksheets(spark, sheets, str(tmp_path / "grid"))
    direct = read_worksheet_csvs(spark, sheets)
    cols = ["expedition", "day_folder", "spreadsheet", "sheet", "row_idx"]
    assert rows(grid, *cols) == rows(direct, *cols)
    checks = publish_plans(spark, str(tmp_path / "drive" / "plans") + "/*/*.csv", str(tmp_path / "meta"),
                           str(tmp_path / "archive"))
    assert rows(checks.select("check").distinct(), "check") == [("missing observer",)]


def test_partition_columns_stay_text(spark, tmp_path):
    from reefcensus.sources.worksheets import read_grid, write_grid

    keys = [("007", "2021-10-26"), ("2021", "12"), ("a", "1.50")]
    data = [(e, d, "s", "t", 0, ["x"]) for e, d in keys]
    df = spark.createDataFrame(data, "expedition string, day_folder string, spreadsheet string, sheet string, "
                                     "row_idx int, cells array<string>")
    write_grid(df, str(tmp_path / "grid"))
    assert rows(read_grid(spark, str(tmp_path / "grid")), "expedition", "day_folder") == keys
    assert read_grid(spark, str(tmp_path / "grid"), expedition="007").count() == 1


def test_archives_are_kept(spark, tmp_path):
    df = spark.createDataFrame([("E", None, "say ""hi"", ok")], "Expedition string, Location string, note string")
    df = df.withColumn("Date", F.lit("2021-01-01").cast("date"))
    for _ in range(2):
        archive_deployments(df, str(tmp_path / "a"))
    folder = tmp_path / "a" / "Expedition=E"
    assert os.listdir(folder) == ["day_folder=NA 2021-01-01"]
    assert len(os.listdir(folder / "day_folder=NA 2021-01-01")) == 2


def test_expedition_build_skips_and_joins(spark, tmp_path):
    from reefcensus.plans.days import build_expedition, join_expedition

    plan, grid = build_survey(spark, tmp_path / "drive")
    complete, table = str(tmp_path / "complete"), str(tmp_path / "expeditions")
    bad = build_expedition(spark, plan, grid, complete, table, str(tmp_path / "backup"))
    assert rows(bad, "day_folder") == [("South Jetty 2023-05-03",)]
    n = spark.read.parquet(table).count()
    assert n == spark.read.parquet(complete).count() > 0 and os.listdir(tmp_path / "backup")
    first = {f.name for f in (tmp_path / "complete").rglob("*.parquet")}
    build_expedition(spark, plan, grid, complete, table)  # nothing new: the stored days stay as they are
    assert {f.name for f in (tmp_path / "complete").rglob("*.parquet")} == first
    assert spark.read.parquet(table).count() == n
    join_expedition(spark, complete, str(tmp_path / "one"), "Camp 2023")
    assert spark.read.parquet(str(tmp_path / "one")).count() == 6


def test_lookups_bind_by_name(spark, tmp_path):
    from reefcensus.sources.lookups import prune_day_folders, read_species_traits, read_surveyor_emails

    write_csv(tmp_path, "e.csv", "email,Club,FullName\n a@reef.example ,x,Obs One \n")
    assert rows(read_surveyor_emails(spark, str(tmp_path / "e.csv")), "FullName", "email") == [
        ("Obs One", "a@reef.example")]
    write_csv(tmp_path, "t.csv", "IUCN,Species,a,b\nLC, Mullus ,0.5,x\n")
    assert rows(read_species_traits(spark, str(tmp_path / "t.csv")), "Species", "a", "b") == [("Mullus", 0.5, None)]
    days = spark.createDataFrame([("EXPEDITION DATA",), ("D 1",)], "day_folder string")
    assert rows(prune_day_folders(days), "day_folder") == [("D 1",)]


def test_stored_tables_keep_the_columns_of_all_writes(spark, tmp_path):
    import pytest

    from reefcensus.sinks.schemas import SchemaConflict, registered_schema, union_schema

    path = str(tmp_path / "days")

    def write(expedition, day, columns, values):
        df = spark.createDataFrame([(expedition, day, *values)], f"expedition string, day_folder string, {columns}")
        write_day_complete(df, path)

    write("007", "1", "n int, note string, m map<string,string>", (1, "a", {"k": "v"}))
    write("007", "2", "N bigint, cells array<struct<p:int,v:string>>", (5_000_000_000, [(1, "x")]))
    write("8", "1.50", "n int, rate double", (3, 0.5))
    got = {(r["expedition"], r["day_folder"]): r for r in read_complete_days(spark, path).collect()}
    assert sorted(got) == [("007", "1"), ("007", "2"), ("8", "1.50")]
    assert [got[k]["n"] for k in sorted(got)] == [1, 5_000_000_000, 3]
    assert got["007", "1"]["m"] == {"k": "v"} and got["007", "2"]["cells"][0]["v"] == "x" and got["8", "1.50"]["rate"] == 0.5
    # another type stops the write before any row is replaced
    with pytest.raises(SchemaConflict, match="note: stored as string, now bigint"):
        write("007", "1", "note bigint", (1,))
    assert read_complete_days(spark, path).filter("note = 'a'").count() == 1
    lines = len(list((tmp_path / "days" / "_schemas").glob("*.json")))
    write("8", "1.50", "n int, rate double", (4, 0.25))  # nothing new: no line
    assert len(list((tmp_path / "days" / "_schemas").glob("*.json"))) == lines == 3
    assert [f.name for f in registered_schema(spark, path)] == [
        "expedition", "day_folder", "n", "note", "m", "cells", "rate"]
    # two writers that did not see each other: the union of both lines
    a, b = (spark.createDataFrame([], s).schema for s in ("x int, y string", "Y string, x double, z int"))
    assert union_schema(a, b).simpleString() == union_schema(b, a).simpleString().replace("Y", "y").replace(
        "y:string,x:double", "x:double,y:string")
    # tables of other writers: the union of their footers
    other = str(tmp_path / "other")
    spark.createDataFrame([("007", 1)], "expedition string, a int").write.partitionBy("expedition").parquet(other)
    spark.createDataFrame([("008", "x")], "expedition string, b string").write.mode("append").partitionBy(
        "expedition").parquet(other)
    assert rows(read_complete_days(spark, other), "expedition", "a", "b") == [("007", 1, None), ("008", None, "x")]

"""Registered queries of the operators that read and write files and stored
tables (A1-A7, K1, K2, K4, K5), and of the check of arrived sheets.

The benchmark tables are packed as plan files, sheets and forms, or written
as stored tables below the shared checkpoint folder, and read back with the
library's readers; the SQL says what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reefcensus.operators import clean, grid, joins, surveyors
from reefcensus.plans.deployment import form_to_plan
from reefcensus.plans.driver_queries import _plan_sql, _plan_surveyor_rows, iso, load, manifest_sql, query
from reefcensus.plans.sql_text import na
from reefcensus.registry import OBSERVATION_REQUIRED
from reefcensus.session import scratch_folder
from reefcensus.sinks import archive_deployments, publish_metadata, write_day_complete, write_expedition
from reefcensus.sources.deployments import csv_records, plan_rows
from reefcensus.sources.lookups import (
    read_complete_days,
    read_partitioned,
    read_published_metadata,
    read_species_traits,
    read_surveyor_emails,
)
from reefcensus.sources.worksheets import sheet_rows

FILE_ROWS = 50  # suppliers in a plan file


def quoted(c: Column) -> Column:
    """A CSV field in quotes; missing reads as nothing."""
    return F.when(c.isNull(), "").otherwise(
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))


# ---------------------------------------------------------------- A1, P1, P3, P5
def _plan_files(spark, sf) -> DataFrame:
    """Suppliers as plan files of two kinds: other headings, order, line ends,
    a byte order mark; blank cells, short rows, blank lines, quotes, commas
    and line feeds within cells."""
    s = load(spark, sf, "supplier")
    n = joins.broadcast_if_small(load(spark, sf, "nation"))
    k = F.col("s_suppkey")
    rows = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("-"),
                 F.floor(k / FILE_ROWS).cast("bigint").cast("string")).alias("file"),
        k.alias("k"), (F.col("n_nationkey") % 2 == 0).alias("plain"),
        F.when(k % 4 == 0, F.concat(F.lit('Bay "'), F.col("n_name"), F.lit('", north'))).alias("location"),
        F.when(k % 3 == 0, F.concat((k % 28 + 1).cast("string"), F.when(k % 2 == 0, "/").otherwise("."),
                                    (k % 12 + 1).cast("string"), F.when(k % 2 == 0, "/").otherwise("."),
                                    F.lit("2020"))).alias("date"),
        F.when(k % 5 == 0, F.concat(F.lit("one\ntwo, "), F.col("s_name"))).alias("notes"),
        F.concat(F.lit("Obs "), F.when(F.col("s_acctbal") > 0, "A").otherwise("B")).alias("first"),
        F.when(F.col("s_acctbal") <= 5000, F.lit("Obs C")).alias("second"))
    site, date = F.concat(F.lit(" "), F.col("k").cast("string"), F.lit("  ")), F.coalesce("date", F.lit(""))
    second = F.coalesce("second", F.lit(""))
    notes = F.when(F.col("notes").isNull(), "").otherwise(F.concat(F.lit(","), quoted(F.col("notes"))))
    # a row whose last cell is blank is one field shorter
    plain = F.concat(F.concat_ws(",", F.lit("TLV"), F.lit(""), quoted(F.col("location")), date, site, "first", second), notes)
    other = F.concat_ws(",", quoted(F.col("notes")), site, second, "first", date, quoted(F.col("location")),
                        F.lit(""), F.lit("TLV"), F.lit("dive 4"))
    line = F.struct("k", F.concat(F.when(F.col("plain"), plain).otherwise(other),
                                  F.when(F.col("k") % 10 == 0, "\n").otherwise("")).alias("line"))
    files = rows.groupBy("file", "plain").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    body = F.transform("lines", lambda x: x["line"])
    head_plain = "Project,Expedition,Location,Date,Site,First Observer,Second Observer,Notes"
    head_other = "﻿Notes,Site,Invertebrate Observer,Fish Observer,Date,Location,Expedition,Project,Dive"
    text = F.when(F.col("plain"), F.array_join(F.concat(F.array(F.lit(head_plain)), body), "\n")).otherwise(
        F.concat(F.array_join(F.concat(F.array(F.lit(head_other)), body), "\r\n"), F.lit("\r\n")))
    return files.select("file", F.col("file").alias("file_name"), text.alias("value"))


@query("csv_plans", f"""
WITH p AS (
  SELECT 'n' || CAST(n_nationkey AS VARCHAR) || '-' || CAST(CAST(floor(s_suppkey / {FILE_ROWS}) AS BIGINT) AS VARCHAR) AS file,
         s_suppkey AS k, CASE WHEN s_acctbal > 0 THEN 'Obs A' ELSE 'Obs B' END AS f1,
         CASE WHEN s_acctbal <= 5000 THEN 'Obs C' END AS f2,
         CASE WHEN s_suppkey % 4 = 0 THEN 'Bay "' || n_name || '", north' END AS loc,
         CASE WHEN s_suppkey % 3 = 0 THEN make_date(2020, CAST(s_suppkey % 12 + 1 AS INTEGER), CAST(s_suppkey % 28 + 1 AS INTEGER)) END AS d,
         CASE WHEN s_suppkey % 5 = 0 THEN 'one' || chr(10) || 'two, ' || s_name END AS notes
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT file, CAST(row_number() OVER w AS INTEGER) AS row_idx, 'TLV' AS "Project", CAST(NULL AS VARCHAR) AS "Expedition",
       last_value(loc IGNORE NULLS) OVER f AS "Location",
       strftime(last_value(d IGNORE NULLS) OVER f, '%Y-%m-%d') AS "Date",
       CAST(k AS VARCHAR) AS "SiteID", f1 AS "First Observer", f2 AS "Second Observer",
       last_value(notes IGNORE NULLS) OVER f AS "Notes", notes AS "Notes as read"
FROM p WINDOW w AS (PARTITION BY file ORDER BY k),
  f AS (PARTITION BY file ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def csv_plans(spark, sf):
    plan = plan_rows(_plan_files(spark, sf), more_columns=["Notes"])
    return plan.select("file", "row_idx", "Project", "Expedition", "Location", iso("Date").alias("Date"), "SiteID",
                       "First Observer", "Second Observer", "Notes",
                       F.try_element_at("row", F.lit("Notes")).alias("Notes as read"))


# ---------------------------------------------------------------- A2
@query("csv_sheets", """
WITH d AS (SELECT doc_id, text, coalesce(lang, 'NA') AS lang,
                  regexp_extract_all(coalesce(text, ''), '[A-Za-z]+') AS w FROM documents)
SELECT lang AS expedition, 'day 1' AS day_folder, CAST(doc_id AS VARCHAR) AS spreadsheet, 'text + 100%' AS sheet,
       1 AS row_idx, 2 AS n_cells, 'whole text' AS first_cell, nullif(text, '') AS last_cell
FROM d
UNION ALL
SELECT lang, 'day 1', CAST(doc_id AS VARCHAR), 'text + 100%', 2, CAST(least(len(w), doc_id % 60) + 1 AS INTEGER), 'words',
       CASE WHEN least(len(w), doc_id % 60) = 0 THEN 'words' ELSE w[least(len(w), doc_id % 60)] END
FROM d
UNION ALL
SELECT lang, 'day 1', CAST(doc_id AS VARCHAR), 'text + 100%', 0, 2, 'Metadata', 'Value' FROM d
""")
def csv_sheets(spark, sf):
    d = load(spark, sf, "documents")
    words = F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), 0), F.lit(1),
                    (F.col("doc_id") % 60).cast("int"))
    text = F.concat(F.lit("Metadata,Value\n\n"), F.lit("whole text,"), quoted(F.col("text")), F.lit("\r\n"),
                    F.array_join(F.concat(F.array(F.lit("words")), words), ","))
    path = F.concat(F.lit("file:/sheets/"), F.coalesce("lang", F.lit("NA")), F.lit("/day 1/"),
                    F.col("doc_id").cast("string"), F.lit("/text + 100%.csv"))
    files = d.select(path.alias("file"), F.lit("text + 100%.csv").alias("file_name"), text.alias("value"))
    out = sheet_rows(csv_records(files))
    return out.select("expedition", "day_folder", "spreadsheet", "sheet", "row_idx", F.size("cells").alias("n_cells"),
                      F.element_at("cells", 1).alias("first_cell"), F.element_at("cells", -1).alias("last_cell"))


# ---------------------------------------------------------------- A3, P11, P13, U1
@query("sheet_cells", """
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS p, CAST(l_suppkey AS VARCHAR) AS s,
                   l_returnflag AS r, CASE WHEN l_tax <> 0 THEN printf('%.2f', l_tax) END AS t, l_linestatus AS ls FROM lineitem)
SELECT l_orderkey, l_linenumber, 1 AS observer_half,
       CASE WHEN l_orderkey % 2 = 0 THEN '1 Species=' || p || '|2 Amount=' || s || '|3 Note=' || r || '|4 -=' || ls
            ELSE '1 Amount=' || s || '|2 Species=' || p || '|3 Amount=' || r END AS cells,
       s AS amount
FROM li
UNION ALL
SELECT l_orderkey, l_linenumber, 2,
       CASE WHEN l_orderkey % 2 = 0 THEN '1 Species=' || s || '|2 Amount=' || t || '|3 Note=NA|4 -=' || r
            ELSE '1 Amount=' || t || '|2 Species=' || s || '|3 Amount=' || ls END,
       t
FROM li WHERE t IS NOT NULL
""")
def sheet_cells(spark, sf):
    """Every order is a sheet with its own header: blank and repeated
    headings, columns in another order, halves of another width."""
    li = load(spark, sf, "lineitem")
    p, s = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    tax, none = F.when(F.col("l_tax") != 0, F.format_string("%.2f", "l_tax")), F.lit(None).cast("string")
    even = F.col("l_orderkey") % 2 == 0
    data = li.select("l_orderkey", F.col("l_linenumber").alias("row_idx"), F.when(even, F.array(
        none, none, p, s, "l_returnflag", "l_linestatus", s, tax, none, F.col("l_returnflag"))).otherwise(F.array(
            none, none, s, p, "l_returnflag", tax, s, "l_linestatus")).alias("cells"))
    heads = [["Metadata", "Value", "Species", "Amount", "Note", None, "Species...7", "Amount...8", "Note...9", "end"],
             ["Metadata", "Value", "Amount...3", "Species", "Amount...5", "Amount...6", "Species...7", "end"]]
    head = [F.array(*[F.lit(h).cast("string") for h in x]) for x in heads]
    header = li.select("l_orderkey").distinct().select(
        "l_orderkey", F.lit(0).alias("row_idx"), F.when(even, head[0]).otherwise(head[1]).alias("cells"))
    rows = grid.observer_rows(data.unionByName(header), ["l_orderkey"], required=OBSERVATION_REQUIRED)
    cells = F.transform("obs_cells", lambda c: F.concat(
        c["position"].cast("string"), F.lit(" "), F.coalesce(c["name"], F.lit("-")), F.lit("="),
        F.coalesce(c["value"], F.lit("NA"))))
    return rows.select("l_orderkey", F.col("row_idx").alias("l_linenumber"), "observer_half",
                       F.array_join(cells, "|").alias("cells"),
                       F.try_element_at("obs", F.lit("Amount")).alias("amount"))


# ---------------------------------------------------------------- A4
@query("form_plans", f"""
WITH s AS (
  SELECT n_nationkey AS form, n_name, s_suppkey, s_name, s_acctbal,
         row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) AS i, count(*) OVER (PARTITION BY n_nationkey) AS c
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT form, CAST(i AS INTEGER) AS row_idx, CASE WHEN form % 3 = 0 THEN NULL ELSE 'Israel' END AS "Country", 'TLV' AS "Project",
       'Trip' AS "Expedition", CASE WHEN c >= 2 THEN n_name END AS "Location",
       CASE WHEN c >= 3 THEN '2021-11-07' END AS "Date", CAST(s_suppkey AS VARCHAR) AS "SiteID",
       s_name AS "First Observer", CASE WHEN s_acctbal > 0 THEN 'Obs B' END AS "Second Observer"
FROM s WHERE form % 5 <> 4 AND (s_suppkey % 6 <> 0)
""")
def form_plans(spark, sf):
    """A nation is a form, its suppliers the deployments; every fifth form
    has two headings for one column and is left out."""
    s = load(spark, sf, "supplier")
    n = joins.broadcast_if_small(load(spark, sf, "nation"))
    j = s.join(n, s.s_nationkey == n.n_nationkey).withColumnRenamed("n_nationkey", "form")
    i = F.col("row_idx")
    key = F.when(i == 1, "Expedition").when(i == 2, "Location").when(i == 3, "Date").when(
        (i == 4) & (F.col("form") % 3 == 0), "Country")
    value = F.when(i == 1, "Trip").when(i == 2, F.col("n_name")).when(i == 3, "2021-11-07")
    numbered = clean.number_rows(j, ["form"], "s_suppkey", "place").withColumn("row_idx", (F.col("place") + 1).cast("int"))
    short = F.col("form") % 3 == 0  # the key Country has no value: no default then
    site = F.when(F.col("s_suppkey") % 6 != 0, F.col("s_suppkey").cast("string"))
    data = numbered.select("form", "row_idx", F.array(
        F.when(short & (i == 1), "Country").otherwise(key), F.when(short & (i == 1), None).otherwise(value), site, "s_name",
        F.when(F.col("s_acctbal") > 0, "Obs B")).alias("cells"))
    # forms with the key Country keep their other keys in rows past the table
    more = n.filter(F.col("n_nationkey") % 3 == 0).select(
        F.col("n_nationkey").alias("form"), F.lit(1_000_000).alias("row_idx"),
        F.array(F.lit("Expedition"), F.lit("Trip")).alias("cells"))
    heads = [["Metadata", "Value", "Site", "Fish Observer", "Invertebrate Observer", None],
             ["Metadata", "Value", "Site", "SiteID", "First Observer"]]
    head = [F.array(*[F.lit(h).cast("string") for h in x]) for x in heads]
    header = n.select(F.col("n_nationkey").alias("form"), F.lit(0).alias("row_idx"),
                      F.when(F.col("n_nationkey") % 5 == 4, head[1]).otherwise(head[0]).alias("cells"))
    forms = data.unionByName(header).unionByName(more)
    plan = form_to_plan(forms, ["form"], project="TLV")
    return plan.select("form", "row_idx", "Country", "Project", "Expedition", "Location", iso("Date").alias("Date"),
                       "SiteID", "First Observer", "Second Observer")


# ---------------------------------------------------------------- A5
@query("surveyor_emails", """
SELECT s_name AS "FullName", CASE WHEN s_acctbal > 0 THEN s_name || '@reef.example' END AS email FROM supplier
""")
def surveyor_emails(spark, sf):
    """The lookup as a CSV folder, columns in another order, one more."""
    path = scratch_folder(spark, "emails")
    s = load(spark, sf, "supplier")
    s.select(F.when(F.col("s_acctbal") > 0, F.concat("s_name", F.lit("@reef.example"))).alias("email"),
             F.lit('a "club", north').alias("Club"), F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("FullName")) \
        .write.option("header", True).option("escape", '"').csv(path)
    return read_surveyor_emails(spark, path)


@query("species_traits", """
SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS "Species", p_retailprice AS a,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS b, p_brand AS "IUCN", p_type AS "Origin"
FROM part
""")
def species_traits(spark, sf):
    path = scratch_folder(spark, "traits")
    p = load(spark, sf, "part")
    p.select(F.col("p_brand").alias("IUCN"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("Species"),
             F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("unknown").alias("b"),
             F.col("p_retailprice").alias("a"), F.col("p_type").alias("Origin")) \
        .write.option("header", True).option("escape", '"').csv(path)
    return read_species_traits(spark, path).select("Species", "a", "b", "IUCN", "Origin")


# ---------------------------------------------------------------- A7, K1: days of other columns
_EVENT_DAY = ("lpad(CAST(user_id % 10 AS VARCHAR), 3, '0') AS expedition, strftime(ts, '%Y-%m-%d') AS day_folder, "
              "event_id")


def _event_days(spark, sf) -> DataFrame:
    e = load(spark, sf, "events")
    return e.select(F.lpad((F.col("user_id") % 10).cast("string"), 3, "0").alias("expedition"), iso("ts").alias("day_folder"),
                    "event_id", "event_type", "value", "props", (F.col("user_id") % 10).alias("u"))


@query("stored_days", f"""
SELECT {_EVENT_DAY}, event_type, CAST(length(props) AS BIGINT) AS n, NULL::DOUBLE AS value, NULL::VARCHAR AS props, NULL::BOOLEAN AS again
FROM events WHERE user_id % 10 < 5
UNION ALL
SELECT {_EVENT_DAY}, NULL, CAST(length(props) AS BIGINT) * 3000000000, value, props, NULL FROM events WHERE user_id % 10 IN (5, 6, 8, 9)
UNION ALL
SELECT {_EVENT_DAY}, NULL, NULL, value, NULL, true FROM events WHERE user_id % 10 = 7
""")
def stored_days(spark, sf):
    """Three builds of one table: other columns, a wider type, and days
    that are built again."""
    path, days = scratch_folder(spark, "days"), _event_days(spark, sf)
    keys = ["expedition", "day_folder", "event_id"]
    write_day_complete(days.filter("u < 5 or u = 7").select(*keys, "event_type", F.length("props").alias("n")), path)
    write_day_complete(days.filter("u in (5, 6, 8, 9)").select(
        *keys, (F.length("props") * F.lit(3_000_000_000)).alias("n"), "value", "props"), path)
    write_day_complete(days.filter("u = 7").select(*keys, "value", F.lit(True).alias("again")), path)
    return read_complete_days(spark, path).select(*keys, "event_type", "n", "value", "props", "again")


# ---------------------------------------------------------------- K2
@query("expedition_days", f"""
SELECT {_EVENT_DAY}, event_type, props FROM events WHERE user_id % 10 <> 3
UNION ALL
SELECT {_EVENT_DAY}, event_type, NULL FROM events WHERE user_id % 10 = 3
""")
def expedition_days(spark, sf):
    """The expedition table, one expedition written again without a column."""
    path, days = scratch_folder(spark, "expeditions"), _event_days(spark, sf)
    columns = ["expedition", "day_folder", "event_id", "event_type", "props"]
    write_expedition(days.select(*columns), path)
    write_expedition(days.filter("u = 3").select(*columns[:-1]), path)
    return read_partitioned(spark, path, ["expedition"]).select(*columns)


# ---------------------------------------------------------------- A6, K5
@query("published_plans", f"""
SELECT o_orderpriority AS expedition, strftime(o_orderdate, '%Y-%m') AS day_folder, o_orderkey,
       CASE WHEN year(o_orderdate) > 1997 THEN o_orderstatus END AS "Weather",
       CASE WHEN year(o_orderdate) <= 1997 THEN CAST(o_custkey AS VARCHAR) END AS "SiteID"
FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def published_plans(spark, sf):
    """Plans published in two rounds with other columns; one expedition read."""
    path, o = scratch_folder(spark, "plans"), load(spark, sf, "orders")
    day = [F.col("o_orderpriority").alias("expedition"), F.date_format("o_orderdate", "yyyy-MM").alias("day_folder"),
           F.col("o_orderkey")]
    early = F.year("o_orderdate") <= 1997
    publish_metadata(o.filter(early).select(*day, F.col("o_custkey").cast("string").alias("SiteID")), path)
    publish_metadata(o.filter(~early).select(*day, F.col("o_orderstatus").alias("Weather")), path)
    return read_published_metadata(spark, path, expedition="1-URGENT").select(
        "expedition", "day_folder", "o_orderkey", "Weather", "SiteID")


# ---------------------------------------------------------------- K4
@query("plan_archive", f"""
SELECT 'Trip "' || CAST(s_nationkey AS VARCHAR) || '"' AS "Expedition",
       coalesce(CASE WHEN s_nationkey % 3 <> 0 THEN 'Bay' END, 'NA') || ' ' ||
       CASE WHEN s_nationkey % 4 = 0 THEN 'NA' ELSE '2021-03-0' || CAST(s_nationkey % 4 AS VARCHAR) END AS day_folder,
       CAST(s_suppkey AS VARCHAR) AS "SiteID", 'said "' || s_name || '", then' AS "Notes", CAST(2 AS BIGINT) AS copies
FROM supplier
""")
def plan_archive(spark, sf):
    """Archived twice: both copies stay, with quotes and commas in cells."""
    path, s = scratch_folder(spark, "archive"), load(spark, sf, "supplier")
    k = F.col("s_nationkey")
    date = F.when(k % 4 != 0, F.concat(F.lit("2021-03-0"), (k % 4).cast("string"))).cast("date")
    plan = s.select(F.concat(F.lit('Trip "'), k.cast("string"), F.lit('"')).alias("Expedition"),
                    F.when(k % 3 != 0, "Bay").alias("Location"), date.alias("Date"),
                    F.col("s_suppkey").cast("string").alias("SiteID"),
                    F.concat(F.lit('said "'), "s_name", F.lit('", then')).alias("Notes"))
    for _ in range(2):
        archive_deployments(plan, path)
    schema = "Location string, Date string, SiteID string, Notes string, Expedition string, day_folder string, created string"
    back = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return back.groupBy("Expedition", "day_folder", "SiteID", "Notes").agg(F.count_distinct("created").alias("copies"))


# ---------------------------------------------------------------- R1 against what arrived
@query("sheet_reconciliation", f"""
WITH m AS ({manifest_sql()}),
e AS (SELECT file, spreadsheet_name AS spreadsheet, sheet, count(*) AS expected, min(deployment) AS dep FROM m GROUP BY ALL),
a AS (
  SELECT file, spreadsheet, sheet, CASE WHEN CAST(dep AS BIGINT) % 11 = 0 THEN 2 ELSE 1 END AS arrived,
         CASE WHEN CAST(dep AS BIGINT) % 13 = 0 THEN 0 ELSE 1 END * CASE WHEN CAST(dep AS BIGINT) % 11 = 0 THEN 2 ELSE 1 END AS filled_rows
  FROM e WHERE CAST(dep AS BIGINT) % 7 <> 0
  UNION ALL
  SELECT DISTINCT file, 'Nobody', 'Extra sheet', 1, 1 FROM m),
b AS (
  SELECT coalesce(e.file, a.file) AS file, coalesce(e.spreadsheet, a.spreadsheet) AS spreadsheet,
         coalesce(e.sheet, a.sheet) AS sheet, coalesce(expected, 0) AS expected, coalesce(arrived, 0) AS arrived,
         coalesce(filled_rows, 0) AS filled_rows
  FROM e FULL JOIN a ON e.file = a.file AND e.spreadsheet = a.spreadsheet AND e.sheet = a.sheet)
SELECT file, spreadsheet, sheet, CAST(expected AS BIGINT) AS expected, CAST(arrived AS BIGINT) AS arrived,
       CAST(filled_rows AS BIGINT) AS filled_rows,
       CASE WHEN arrived = 0 THEN 'missing' WHEN expected = 0 THEN 'unexpected'
            WHEN arrived > 1 OR expected > 1 THEN 'duplicate' WHEN filled_rows = 0 THEN 'empty' ELSE 'ok' END AS status
FROM b
""")
def sheet_reconciliation(spark, sf):
    """The expected sheets of the supplier plans against a grid in which some
    did not come, some came twice, some are empty and some nobody expects."""
    m = surveyors.worksheet_manifest(_plan_surveyor_rows(spark, sf), ["file"])
    sheets = m.groupBy("file", F.col("spreadsheet_name").alias("spreadsheet"), "sheet").agg(
        F.min("deployment").cast("bigint").alias("d"))
    came = sheets.filter(F.col("d") % 7 != 0).select(
        "file", "spreadsheet", "sheet", F.explode(F.sequence(F.lit(1), F.when(F.col("d") % 11 == 0, 2).otherwise(1))).alias("c"),
        F.when(F.col("d") % 13 == 0, None).otherwise("x").alias("cell"))
    extra = m.select("file").distinct().select(
        "file", F.lit("Nobody").alias("spreadsheet"), F.explode(F.array(F.lit("Extra sheet"), F.lit("Species List")))
        .alias("sheet"), F.lit(1).alias("c"), F.lit("x").alias("cell"))
    none = F.lit(None).cast("string")
    rows = came.unionByName(extra).select("file", "spreadsheet", "sheet", F.inline(F.array(
        F.struct(F.lit(0).alias("row_idx"), F.array(F.lit("Metadata"), F.lit("Value"), F.lit("Species")).alias("cells")),
        F.struct(F.lit(1).alias("row_idx"), F.array(none, none, F.col("cell")).alias("cells")))))
    return surveyors.reconcile_sheets(m, rows, ["file"])

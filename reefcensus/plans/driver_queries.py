"""The survey operators run on the driver's benchmark tables.

Each entry reads whole tables from ``sf_dir`` (no row subsets), shapes them
like survey data (plans, sheets, observations, lookups) with plain column
expressions, runs the library operator, and renders dates as ISO text and
floating results rounded, so the DuckDB oracle can compare values. Each key
has the equivalent SQL next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefcensus.functions.dates import parse_day_first, season
from reefcensus.functions.labels import deployment_key, group_flag, layer_letter
from reefcensus.functions.text import with_canonical
from reefcensus.operators import checks, clean, complete, cover, grid, joins, surveyors, traits
from reefcensus.plans.deployment import day_label
from reefcensus.plans.sql_text import canon_text, na, q, ymd
from reefcensus.plans.sql_text import season as season_sql
from reefcensus.registry import (
    COVER_CATEGORIES,
    FISH_LAYOUT,
    INVERT_LAYOUT,
    OBSERVATION_REQUIRED,
    TLV_METADATA_KEYS,
    TLV_SEGMENTS,
)
from reefcensus.sinks import with_backup_flag

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def iso(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def znorm(c) -> F.Column:
    """-0.0 -> 0.0 (IEEE: x + 0.0)."""
    c = F.col(c) if isinstance(c, str) else c
    return c + F.lit(0.0)


# ---------------------------------------------------------------- P1, P2
@query("heading_normalise", f"""
SELECT 'Israel' AS "Country", 'TLV' AS "Project", o_orderpriority AS "Expedition",
       {ymd('o_orderdate')} AS "Date", o_orderkey AS "SiteID",
       CAST(o_custkey AS VARCHAR) AS "First Observer", o_orderstatus AS "Second Observer"
FROM orders
""")
def heading_normalise(spark, sf):
    o = load(spark, sf, "orders")
    sheet = o.select(
        F.col("o_orderpriority").alias("Expedition"), iso("o_orderdate").alias("Date"),
        F.col("o_orderkey").alias("Site"), F.col("o_custkey").cast("string").alias("Fish Observer"),
        F.col("o_orderstatus").alias("Invertebrate Observer"), F.col("o_totalprice").alias("Dive"))
    return clean.add_defaults(clean.normalise_headings(sheet), project="TLV")


# ---------------------------------------------------------------- P3, P4
_FILL_W = "(PARTITION BY {by} ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("fill_down", f"""
SELECT event_id, user_id, event_type,
  last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER {_FILL_W.format(by='user_id')} AS value_filled,
  last_value(CASE WHEN event_type = 'click' THEN props END IGNORE NULLS) OVER {_FILL_W.format(by='user_id')} AS props_filled
FROM events
""")
def fill_down(spark, sf):
    e = load(spark, sf, "events")
    shaped = e.select("event_id", "user_id", "event_type",
                      F.when(F.col("event_type") == "view", F.col("value")).alias("value_filled"),
                      F.when(F.col("event_type") == "click", F.col("props")).alias("props_filled"))
    return clean.fill_down(shaped, ["user_id"], "event_id", ["value_filled", "props_filled"])


@query("fill_down_grouped", f"""
SELECT event_id, user_id, event_type,
  last_value(CASE WHEN value >= 50 THEN value END IGNORE NULLS) OVER {_FILL_W.format(by='user_id, event_type')} AS value_filled,
  last_value(CASE WHEN value < 20 THEN props END IGNORE NULLS) OVER {_FILL_W.format(by='user_id, event_type')} AS props_filled
FROM events
""")
def fill_down_grouped(spark, sf):
    e = load(spark, sf, "events")
    shaped = e.select("event_id", "user_id", "event_type",
                      F.when(F.col("value") >= 50, F.col("value")).alias("value_filled"),
                      F.when(F.col("value") < 20, F.col("props")).alias("props_filled"))
    return clean.fill_down(shaped, ["user_id", "event_type"], "event_id",
                           ["value_filled", "props_filled"])


# ---------------------------------------------------------------- P5
@query("parse_dates", """
SELECT o_orderkey, date_text,
       strftime(strptime(replace(date_text, '.', '/'), '%d/%m/%Y'), '%Y-%m-%d') AS parsed_date
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-d/%-m/%Y')
                  ELSE strftime(o_orderdate, '%-d.%-m.%Y') END AS date_text
      FROM orders)
""")
def parse_dates(spark, sf):
    o = load(spark, sf, "orders")
    txt = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(
        F.date_format("o_orderdate", "d.M.yyyy"))
    shaped = o.select("o_orderkey", txt.alias("date_text"))
    return shaped.select("o_orderkey", "date_text",
                         F.date_format(parse_day_first("date_text"), "yyyy-MM-dd").alias("parsed_date"))


# ---------------------------------------------------------------- P6, P7, Q1
_META_KEYS = ["Status", "Priority", "Total", "Customer", "Missing"]


@query("metadata_pivot", f"""
SELECT o_orderkey,
       {canon_text('o_orderstatus')} AS "Status",
       {canon_text('o_orderpriority')} AS "Priority",
       {canon_text("printf('%.2f', o_totalprice)")} AS "Total",
       {canon_text("lpad(CAST(o_custkey AS VARCHAR), 6, '0')")} AS "Customer",
       CAST(NULL AS VARCHAR) AS "Missing"
FROM orders
""")
def metadata_pivot(spark, sf):
    o = load(spark, sf, "orders")
    pairs = o.select("o_orderkey", F.inline(F.array(
        F.struct(F.lit(1).alias("row_idx"), F.lit("Status").alias("k"), F.col("o_orderstatus").alias("v")),
        F.struct(F.lit(2).alias("row_idx"), F.lit("Priority").alias("k"), F.col("o_orderpriority").alias("v")),
        F.struct(F.lit(3).alias("row_idx"), F.lit("Total").alias("k"),
                 F.format_string("%.2f", "o_totalprice").alias("v")),
        F.struct(F.lit(4).alias("row_idx"), F.lit("Customer").alias("k"),
                 F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("v")),
        F.struct(F.lit(5).alias("row_idx"), F.lit(None).cast("string").alias("k"), F.lit("blank key row").alias("v")),
    )))
    pairs = pairs.filter(F.col("k").isNotNull())
    return grid.metadata_columns(grid.metadata_map(pairs, ["o_orderkey"]), ["o_orderkey"], _META_KEYS).drop("metadata")


@query("canonical_values", f"""
SELECT p_partkey,
       {canon_text("lpad(CAST(p_size AS VARCHAR), 3, '0')")} AS size_txt,
       {canon_text("printf('%.2f', p_retailprice)")} AS price_txt,
       {canon_text("printf('%.1f', p_retailprice * 1000)")} AS big_txt,
       {canon_text("printf('%.8f', p_retailprice / 1000000)")} AS small_txt,
       {canon_text("CASE WHEN p_size > 25 THEN 'T' ELSE 'false' END")} AS flag_txt,
       {canon_text("CASE WHEN p_size < 5 THEN '  ' WHEN p_size < 10 THEN 'NA' ELSE p_type END")} AS text_txt
FROM part
""")
def canonical_values(spark, sf):
    p = load(spark, sf, "part")
    return with_canonical(p.select("p_partkey", "p_size", "p_retailprice", "p_type"), {
        "size_txt": F.lpad(F.col("p_size").cast("string"), 3, "0"),
        "price_txt": F.format_string("%.2f", "p_retailprice"),
        "big_txt": F.format_string("%.1f", F.col("p_retailprice") * 1000),
        "small_txt": F.format_string("%.8f", F.col("p_retailprice") / 1000000),
        "flag_txt": F.when(F.col("p_size") > 25, "T").otherwise("false"),
        "text_txt": F.when(F.col("p_size") < 5, "  ").when(F.col("p_size") < 10, "NA").otherwise(F.col("p_type")),
    }).drop("p_size", "p_retailprice", "p_type")


# ---------------------------------------------------------------- P8, P9, P10
@query("single_value_check", """
SELECT c_nationkey,
       CAST(count(DISTINCT seg) + max(CASE WHEN seg IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_values,
       min(coalesce(seg, 'NA')) AS least_value, max(coalesce(seg, 'NA')) AS greatest_value,
       'one segment' AS "check"
FROM (SELECT c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer)
GROUP BY c_nationkey
HAVING count(DISTINCT seg) + max(CASE WHEN seg IS NULL THEN 1 ELSE 0 END) > 1
""")
def single_value_check(spark, sf):
    c = load(spark, sf, "customer")
    shaped = c.select("c_nationkey", F.when(F.col("c_acctbal") < 0, None)
                      .otherwise(F.col("c_mktsegment")).alias("seg"))
    return checks.single_value_violations(shaped, ["c_nationkey"], "seg", "one segment")


@query("missing_observers", """
SELECT c_nationkey,
       CAST(count_if(obs1 IS NULL) AS BIGINT) AS "missing obs1",
       CAST(count_if(obs2 IS NULL) AS BIGINT) AS "missing obs2"
FROM (SELECT c_nationkey, nullif(c_mktsegment, 'BUILDING') AS obs1,
             CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_name END AS obs2 FROM customer)
GROUP BY c_nationkey
HAVING count_if(obs1 IS NULL) > 0 OR count_if(obs2 IS NULL) > 0
""")
def missing_observers(spark, sf):
    c = load(spark, sf, "customer")
    shaped = c.select("c_nationkey",
                      F.when(F.col("c_mktsegment") == "BUILDING", None)
                      .otherwise(F.col("c_mktsegment")).alias("obs1"),
                      F.when(F.col("c_acctbal") > 9000, None).otherwise(F.col("c_name")).alias("obs2"))
    return checks.missing_counts(shaped, ["c_nationkey"], ["obs1", "obs2"])


_SEGMENT_PROJECT = [("AUTOMOBILE", "Bioblitz"), ("BUILDING", "FunDiversity"),
                    ("FURNITURE", "EcoCamp"), ("HOUSEHOLD", "TLV")]


def _segment_project_sql() -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{p}'" for s, p in _SEGMENT_PROJECT)
    return f"CASE c_mktsegment {whens} ELSE 'Night Dive' END"


def _segment_project():
    expr = None
    for s, p in _SEGMENT_PROJECT:
        cond = F.col("c_mktsegment") == s
        expr = F.when(cond, p) if expr is None else expr.when(cond, p)
    return expr.otherwise("Night Dive")


@query("project_family", f"""
SELECT c_custkey, "Project",
       CASE "Project" WHEN 'Bioblitz' THEN 'Mediterranean Transects' WHEN 'ASSEMBLE' THEN 'Mediterranean Transects'
                      WHEN 'FunDiversity' THEN 'Eilat Transects' WHEN 'EcoCamp' THEN 'Eilat Knolls'
                      WHEN 'TLV' THEN 'Tel Aviv Transects' WHEN 'Juveniles' THEN 'Eilat Juveniles Transects'
                      WHEN 'Juveniles Knolls' THEN 'Eilat Juveniles Knolls'
                      WHEN 'Juveniles Artificial' THEN 'Eilat Juveniles Artificial' END AS family
FROM (SELECT c_custkey, {_segment_project_sql()} AS "Project" FROM customer)
""")
def project_family(spark, sf):
    c = load(spark, sf, "customer")
    return complete.attach_family(c.select("c_custkey", _segment_project().alias("Project")))


# ---------------------------------------------------------------- P11, P12
@query("complete_rows", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS "Species",
       l_discount + 0.0 AS "Amount", l_tax + 0.0 AS "Length"
FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0
""")
def complete_rows(spark, sf):
    li = load(spark, sf, "lineitem")
    shaped = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("Species"),
                       znorm(F.when(F.col("l_discount") != 0, F.col("l_discount"))).alias("Amount"),
                       znorm(F.when(F.col("l_tax") != 0, F.col("l_tax"))).alias("Length"))
    return clean.complete_rows(shaped, OBSERVATION_REQUIRED)


@query("any_present", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0
""")
def any_present(spark, sf):
    li = load(spark, sf, "lineitem")
    shaped = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("Site"),
                       F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("Spot"))
    return clean.any_present(shaped, ["Site", "SiteID", "Knoll", "Spot"]).drop("Site", "Spot")


# ---------------------------------------------------------------- P13, A3, P14
@query("observer_split", """
SELECT l_orderkey, l_linenumber, 1 AS observer_half, CAST(l_partkey AS VARCHAR) AS "Species",
       CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Amount"
FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 2 AS observer_half, CAST(l_suppkey AS VARCHAR) AS "Species",
       printf('%.2f', l_tax) AS "Amount"
FROM lineitem WHERE l_tax <> 0
""")
def observer_split(spark, sf):
    li = load(spark, sf, "lineitem")
    sheet = li.select(
        F.col("l_orderkey"), F.col("l_linenumber").alias("row_idx"),
        F.array(F.lit(None).cast("string"), F.lit(None).cast("string"),
                F.col("l_partkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"),
                F.col("l_suppkey").cast("string"),
                F.when(F.col("l_tax") != 0, F.format_string("%.2f", "l_tax"))).alias("cells"))
    rows = grid.observer_rows(sheet, ["l_orderkey"], paired=True, required=OBSERVATION_REQUIRED,
                              header=["Metadata", "Value", "Species", "Amount", "Species...5", "Amount...6"])
    return rows.select("l_orderkey", F.col("row_idx").alias("l_linenumber"), "observer_half",
                       F.try_element_at("obs", F.lit("Species")).alias("Species"),
                       F.try_element_at("obs", F.lit("Amount")).alias("Amount"))


@query("recycle_metadata", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, {ymd('o_orderdate')} AS o_orderdate,
       l_linenumber, l_partkey, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def recycle_metadata(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         iso("o_orderdate").alias("o_orderdate"))
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                                            "l_partkey", "l_quantity")
    return grid.recycle_metadata(o, li, ["o_orderkey"])


# ---------------------------------------------------------------- P15, P16, P17
_LAYER_SHEET_SQL = ("'Site ' || CAST(p_partkey AS VARCHAR) || ' - Transect A - ' || "
                    "(CASE p_type WHEN 'SMALL' THEN 'CRYPTIC' WHEN 'PROMO' THEN 'TRANSIENTS' "
                    "WHEN 'LARGE' THEN 'Juveniles' ELSE p_type END) || "
                    "(CASE WHEN p_name LIKE 'red%' THEN ' - Juveniles' ELSE '' END)")


@query("layer_letter", f"""
SELECT p_partkey, sheet,
       CASE WHEN regexp_matches(sheet, 'TRANSIENTS') THEN 'T' WHEN regexp_matches(sheet, 'CRYPTIC') THEN 'C'
            WHEN regexp_matches(sheet, 'Juveniles') THEN 'J' END AS "Letter"
FROM (SELECT p_partkey, {_LAYER_SHEET_SQL} AS sheet FROM part)
""")
def layer_letter_q(spark, sf):
    p = load(spark, sf, "part")
    layer = (F.when(F.col("p_type") == "SMALL", "CRYPTIC").when(F.col("p_type") == "PROMO", "TRANSIENTS")
             .when(F.col("p_type") == "LARGE", "Juveniles").otherwise(F.col("p_type")))
    sheet = F.concat(F.lit("Site "), F.col("p_partkey").cast("string"), F.lit(" - Transect A - "), layer,
                     F.when(F.col("p_name").like("red%"), " - Juveniles").otherwise(""))
    shaped = p.select("p_partkey", sheet.alias("sheet"))
    return shaped.withColumn("Letter", layer_letter("sheet"))




@query("group_flag", """
SELECT p_partkey, sheet,
       CASE WHEN sheet IS NULL THEN NULL WHEN regexp_matches(sheet, 'Fish') THEN 'Fish'
            ELSE 'Invertebrates' END AS "Group"
FROM (SELECT p_partkey,
             CASE WHEN p_size = 50 THEN NULL
                  ELSE CAST(p_partkey AS VARCHAR) || ' - ' || replace(p_name, 'blue', 'Fish') END AS sheet
      FROM part)
""")
def group_flag_q(spark, sf):
    p = load(spark, sf, "part")
    sheet = F.when(F.col("p_size") == 50, None).otherwise(
        F.concat(F.col("p_partkey").cast("string"), F.lit(" - "), F.replace("p_name", F.lit("blue"), F.lit("Fish"))))
    shaped = p.select("p_partkey", sheet.alias("sheet"))
    return shaped.withColumn("Group", group_flag("sheet"))




@query("deployment_key", f"""
SELECT n_nationkey,
       {na('n_name')} || ' and ' || {na("nullif(r_name, 'ASIA')")} || ' - ' || {na('n_nationkey')} AS meta_to_deployment_id,
       {na('n_name')} || ' and ' || {na("nullif(r_name, 'ASIA')")} || ' and ' || {na('r_name')} || ' and ' ||
       {na('NULL')} || ' - ' || {na('n_nationkey')} AS juveniles_key
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def deployment_key_q(spark, sf):
    n = load(spark, sf, "nation")
    r = joins.broadcast_if_small(load(spark, sf, "region"))
    j = n.join(r, n.n_regionkey == r.r_regionkey)
    second = F.when(F.col("r_name") == "ASIA", None).otherwise(F.col("r_name"))
    return j.select(
        "n_nationkey",
        deployment_key("n_name", second, "n_nationkey").alias("meta_to_deployment_id"),
        deployment_key("n_name", second, "n_nationkey",
                       juveniles=["r_name", F.lit(None).cast("string")]).alias("juveniles_key"))




# ---------------------------------------------------------------- P18, P19
@query("zero_fill", """
SELECT l_orderkey, l_linenumber AS "Quadrate",
       coalesce(nullif(l_tax, 0), 0) + 0.0 AS tax, coalesce(nullif(l_discount, 0), 0) + 0.0 AS disc,
       coalesce(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END, '0') AS flag
FROM lineitem WHERE l_linenumber <> 7
""")
def zero_fill(spark, sf):
    li = load(spark, sf, "lineitem")
    shaped = li.select("l_orderkey",
                       F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("Quadrate"),
                       znorm(F.when(F.col("l_tax") != 0, F.col("l_tax"))).alias("tax"),
                       znorm(F.when(F.col("l_discount") != 0, F.col("l_discount"))).alias("disc"),
                       F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"))
    return clean.zero_fill(shaped, "Quadrate", ["tax", "disc", "flag"])


def _season_sql(x: str) -> str:
    return season_sql(x)


@query("season", f"""
SELECT o_orderkey, {_season_sql('o_orderdate')} AS "Season" FROM orders
""")
def season_q(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", season("o_orderdate").alias("Season"))




# ---------------------------------------------------------------- J4, P20
def _traits(spark, sf) -> DataFrame:
    p = load(spark, sf, "part")
    # species that no observation names: another key, not fewer rows
    return p.select(
        F.concat(F.when(F.col("p_size") == 1, "no ").otherwise(""), F.col("p_partkey").cast("string")).alias("Species"),
        (F.col("p_retailprice") / 99991).alias("a"), (F.col("p_size") / 23.0).alias("b"),
        F.when(F.col("p_size") > 40, "VU").otherwise("LC").alias("IUCN"))


_TRAITS_SQL = ("(SELECT CASE WHEN p_size = 1 THEN 'no ' ELSE '' END || CAST(p_partkey AS VARCHAR) AS \"Species\", p_retailprice / 99991 AS a, "
               "p_size / 23.0 AS b, CASE WHEN p_size > 40 THEN 'VU' ELSE 'LC' END AS \"IUCN\" "
               "FROM part)")


@query("trait_weight", f"""
SELECT l_orderkey, l_linenumber, s."Species", round(t.a, 8) AS a, round(t.b, 4) AS b, t."IUCN",
       round(CAST(s."Amount" AS DOUBLE) * (t.a * pow(CAST(s."Length" AS DOUBLE), t.b)) / 1000, 6) AS weight_kg
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS "Species",
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Amount",
             CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) AS "Length" FROM lineitem) s
LEFT JOIN {_TRAITS_SQL} t ON s."Species" = t."Species"
""")
def trait_weight(spark, sf):
    li = load(spark, sf, "lineitem")
    obs = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("Species"),
                    F.col("l_quantity").cast("bigint").cast("string").alias("Amount"),
                    F.floor(F.col("l_extendedprice") / 1000).cast("bigint").cast("string").alias("Length"))
    out = traits.add_species_traits(obs, _traits(spark, sf))
    return out.select("l_orderkey", "l_linenumber", "Species", F.round("a", 8).alias("a"),
                      F.round("b", 4).alias("b"), "IUCN", F.round("weight_kg", 6).alias("weight_kg"))


# ---------------------------------------------------------------- P21
@query("transect_ids", f"""
SELECT o_orderkey,
  key || '_' || {ymd('o_orderdate')} || '_' || {na('tr')} AS "Transect_id",
  key || '_' || {ymd('o_orderdate')} AS "Survey_id",
  key || '_' || {ymd('o_orderdate')} || '_' || {na('tr')} || ' ' || {na('quad')} AS "Quadrate_id"
FROM (SELECT o_orderkey, o_orderdate, {na("'C' || CAST(o_custkey AS VARCHAR)")} || ' and ' || {na('o_orderpriority')}
             || ' - ' || {na('o_orderkey')} AS key,
             nullif(o_orderstatus, 'P') AS tr, CAST(floor(o_totalprice / 100000) AS BIGINT) AS quad FROM orders)
""")
def transect_ids(spark, sf):
    o = load(spark, sf, "orders")
    shaped = o.select(
        "o_orderkey", F.to_date("o_orderdate").alias("Date"),
        deployment_key(F.concat(F.lit("C"), F.col("o_custkey").cast("string")), "o_orderpriority",
                       "o_orderkey").alias("meta_to_deployment_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("Transect"),
        F.floor(F.col("o_totalprice") / 100000).cast("bigint").alias("Quadrate"))
    out = traits.add_ids(shaped, quadrate="Quadrate")
    return out.select("o_orderkey", "Transect_id", "Survey_id", "Quadrate_id")


# ---------------------------------------------------------------- P22, P23, P24
_PRIORITY_SEGMENT = [("1-URGENT", "Zuk_North"), ("2-HIGH", "Reading"), ("3-MEDIUM", "Jaffa"),
                     ("4-NOT SPECIFIED", "Givat_Alia")]


def _priority_segment():
    expr = None
    for p, s in _PRIORITY_SEGMENT:
        cond = F.col("o_orderpriority") == p
        expr = F.when(cond, s) if expr is None else expr.when(cond, s)
    return expr.otherwise("Open_Sea")


def _priority_segment_sql() -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{s}'" for p, s in _PRIORITY_SEGMENT)
    return f"CASE o_orderpriority {whens} ELSE 'Open_Sea' END"


def _segments_sql() -> str:
    rows = ", ".join(f"({n}, '{s}')" for n, s in TLV_SEGMENTS)
    return f"(SELECT * FROM (VALUES {rows}) v(\"Site_number\", \"Segment\"))"


def _complete_fish(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    meta = o.select(F.lit("TLV").alias("Project"), F.col("o_custkey").cast("string").alias("Spot"),
                    F.to_date("o_orderdate").alias("Date"), F.col("o_orderkey"),
                    F.lit(None).cast("string").alias("Lat"), F.lit(None).cast("string").alias("Lon"),
                    F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("First Observer"),
                    F.col("o_orderstatus").alias("Second Observer"))
    meta = meta.withColumn("meta_to_deployment_id",
                           deployment_key("First Observer", "Second Observer", "Spot"))
    sheet_meta = with_canonical(o.select("o_orderkey", _priority_segment().alias("Segment"),
                                         F.format_string("%.2f", "o_totalprice").alias("Depth Start")),
                                {"Depth Start": "Depth Start"})
    samples = li.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").cast("string").alias("Transect"),
        F.col("l_returnflag").alias("Substrate Type"),
        F.col("l_linestatus").alias("Visibility"), F.col("l_partkey").cast("string").alias("Species"),
        F.col("l_quantity").cast("bigint").cast("string").alias("Amount"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").cast("string").alias("Length"),
        F.col("l_suppkey").cast("string").alias("Distance"))
    samples = traits.tag_group(grid.recycle_metadata(sheet_meta, samples, ["o_orderkey"]), "Fish")
    return complete.day_complete(meta.withColumnRenamed("First Observer", "Fish Observer")
                                 .withColumnRenamed("Second Observer", "Invertebrate Observer"),
                                 samples, by=[], key="o_orderkey")


def _fish_sql() -> str:
    src = {
        "Project": "'TLV'", "Site": 's."Segment"', "Site_number": 'g."Site_number"',
        "Survey_id": f"k.key || '_' || {ymd('o.o_orderdate')}",
        "Spot": "CAST(o.o_custkey AS VARCHAR)", "Date": ymd("o.o_orderdate"),
        "Season": _season_sql("o.o_orderdate"),
        "Fish_Observer": "'C' || CAST(o.o_custkey AS VARCHAR)", "Invertebrate_Observer": "o.o_orderstatus",
        "Transect": "CAST(l.l_linenumber AS VARCHAR)",
        "Transect_id": f"k.key || '_' || {ymd('o.o_orderdate')} || '_' || {na('l.l_linenumber')}",
        "Substrate_type": "l.l_returnflag",
        "Depth Start": "CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE "
                       + canon_text("printf('%.2f', o.o_totalprice)") + " END",
        "Visibility": "l.l_linestatus", "Group": "CASE WHEN l.l_orderkey IS NULL THEN NULL ELSE 'Fish' END",
        "Species": "CAST(l.l_partkey AS VARCHAR)", "Amount": "CAST(CAST(l.l_quantity AS BIGINT) AS DOUBLE)",
        "Length": "CAST(floor(l.l_extendedprice / 1000) AS DOUBLE)",
        "Distance": "CAST(l.l_suppkey AS VARCHAR)", "a": "round(t.a, 8)", "b": "round(t.b, 4)",
        "weight_kg": ("round(CAST(l.l_quantity AS BIGINT) * (t.a * pow(floor(l.l_extendedprice / 1000), t.b)) / 1000, 6)"),
        "IUCN": 't."IUCN"',
    }
    cols = ", ".join(f"{src.get(name, 'CAST(NULL AS VARCHAR)')} AS {q(name)}" for name, _ in FISH_LAYOUT)
    return f"""
SELECT {cols}
FROM orders o
JOIN (SELECT o_orderkey, {na("'C' || CAST(o_custkey AS VARCHAR)")} || ' and ' || {na('o_orderstatus')} || ' - '
             || {na('o_custkey')} AS key FROM orders) k ON k.o_orderkey = o.o_orderkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT o_orderkey, {_priority_segment_sql()} AS "Segment" FROM orders) s
       ON s.o_orderkey = l.l_orderkey
LEFT JOIN {_segments_sql()} g ON g."Segment" = s."Segment"
LEFT JOIN {_TRAITS_SQL} t ON t."Species" = CAST(l.l_partkey AS VARCHAR)
"""


@query("fish_layout", _fish_sql())
def fish_layout(spark, sf):
    out = traits.format_fish(_complete_fish(spark, sf), _traits(spark, sf))
    return (out.withColumn("Date", iso("Date")).withColumn("a", F.round("a", 8))
            .withColumn("b", F.round("b", 4)).withColumn("weight_kg", F.round("weight_kg", 6)))


def _complete_invert(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part")
    meta = o.select(F.lit("TLV").alias("Project"), F.col("o_custkey").cast("string").alias("Spot"),
                    F.to_date("o_orderdate").alias("Date"), "o_orderkey",
                    F.col("o_custkey").cast("string").alias("Fish Observer"),
                    F.col("o_orderpriority").alias("Invertebrate Observer"))
    meta = meta.withColumn("meta_to_deployment_id",
                           deployment_key("Fish Observer", "Invertebrate Observer", "Spot"))
    quad = li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("A").alias("Transect"),
        _size_segment().alias("Segment"),
        F.col("l_linenumber").alias("Quadrate"), F.col("p_name").alias("Taxon"),
        F.col("l_quantity").alias("Count"), (F.col("p_size") / 10.0).alias("Complexity"),
        (znorm("l_discount") * 100).alias("Sand"), (znorm("l_tax") * 100).alias("Rock"),
        F.col("p_brand").alias("1"), F.col("p_type").alias("16"))
    for c in COVER_CATEGORIES:
        if c not in ("Sand", "Rock"):
            quad = quad.withColumn(c, F.lit(0.0))
    return complete.day_complete(meta, traits.tag_group(quad, "Invertebrates"), by=[], key="o_orderkey")


def _size_segment():
    return F.when(F.col("p_size") <= 14, F.lit(None).cast("string")).otherwise(F.lit("Dolfinarium"))


def _invert_sql() -> str:
    key = f"{na('CAST(o.o_custkey AS VARCHAR)')} || ' and ' || {na('o.o_orderpriority')} || ' - ' || {na('o.o_custkey')}"
    tid = f"{key} || '_' || {ymd('o.o_orderdate')} || '_' || {na('x.tr')}"
    src = {
        "Project": "'TLV'", "Site": "x.seg", "Site_number": 'g."Site_number"',
        "Survey_id": f"{key} || '_' || {ymd('o.o_orderdate')}",
        "Spot": "CAST(o.o_custkey AS VARCHAR)", "Date": ymd("o.o_orderdate"),
        "Season": _season_sql("o.o_orderdate"),
        "Fish_Observer": "CAST(o.o_custkey AS VARCHAR)", "Invertebrate_Observer": "o.o_orderpriority",
        "Group": "CASE WHEN x.o_orderkey IS NULL THEN NULL ELSE 'Invertebrates' END",
        "Method": "'Quadrate'", "Transect": "x.tr", "Transect_id": tid,
        "Quadrate_number": "x.quad", "Quadrate_id": f"{tid} || ' ' || {na('x.quad')}",
        "Taxon": "x.taxon", "Count": "x.cnt", "Complexity": "x.cx",
        "Sand": "x.sand", "Rock": "x.rock", "1": "x.brand", "16": "x.ptype",
    }
    for c in COVER_CATEGORIES:
        if c not in ("Sand", "Rock"):
            src[c] = "CASE WHEN x.o_orderkey IS NULL THEN NULL ELSE CAST(0.0 AS DOUBLE) END"
    cols = ", ".join(f"{src.get(name, 'CAST(NULL AS VARCHAR)')} AS {q(name)}" for name, _ in INVERT_LAYOUT)
    return f"""
SELECT {cols}
FROM orders o
LEFT JOIN (SELECT l_orderkey AS o_orderkey, 'A' AS tr,
                  CASE WHEN p_size <= 14 THEN NULL ELSE 'Dolfinarium' END AS seg,
                  l_linenumber AS quad, p_name AS taxon, l_quantity AS cnt, p_size / 10.0 AS cx,
                  (l_discount + 0.0) * 100 AS sand, (l_tax + 0.0) * 100 AS rock, p_brand AS brand, p_type AS ptype
           FROM lineitem JOIN part ON l_partkey = p_partkey) x ON x.o_orderkey = o.o_orderkey
LEFT JOIN {_segments_sql()} g ON g."Segment" = x.seg
"""


@query("invert_layout", _invert_sql())
def invert_layout(spark, sf):
    out = traits.format_invertebrates(_complete_invert(spark, sf))
    return out.withColumn("Date", iso("Date"))


# ---------------------------------------------------------------- P25
@query("layout_cutoff", """
SELECT DISTINCT o_orderpriority, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS "Date",
       'date before 1996-01-01' AS "check"
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01'
""")
def layout_cutoff(spark, sf):
    o = load(spark, sf, "orders").select("o_orderpriority", F.to_date("o_orderdate").alias("Date"))
    bad = checks.before_cutoff(o, "Date", "1996-01-01", by=["o_orderpriority"])
    return bad.withColumn("Date", iso("Date"))


# ---------------------------------------------------------------- Q2-Q5
def _part_sheets(spark, sf) -> DataFrame:
    """Invertebrate sheets made of part rows: 35 data rows per sheet."""
    p = load(spark, sf, "part")
    row = (F.col("p_partkey") % 35 + 1).cast("int")
    keys_arr = F.array(*[F.lit(k) for k in TLV_METADATA_KEYS])
    c1 = (F.when(row <= 14, F.element_at(keys_arr, row))
          .when(row >= 17, F.col("p_brand")))
    c2 = F.when(row <= 14, F.col("p_name")).when(row >= 17, F.col("p_type"))
    cells = F.array(
        c1, c2, F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.col("p_brand"),
        F.col("p_name"), F.when(F.col("p_size") > 10, F.col("p_type")), F.col("p_size").cast("string"),
        F.format_string("%.2f", "p_retailprice"), F.col("p_size").cast("string"),
        F.concat(F.lit("Brand#"), F.col("p_size").cast("string")), F.col("p_type"), F.col("p_name"),
        F.when(F.col("p_size") % 2 == 0, F.lit("x")).otherwise(F.col("p_size").cast("string")))
    return p.select(F.floor(F.col("p_partkey") / 35).cast("long").alias("sheet"), row.alias("row_idx"),
                    cells.alias("cells"))


_PART_CELLS_SQL = f"""
SELECT CAST(floor(p_partkey / 35) AS BIGINT) AS sheet, CAST(p_partkey % 35 + 1 AS INTEGER) AS row_idx,
  CASE WHEN p_partkey % 35 + 1 <= 14 THEN ({'[' + ', '.join("'" + k + "'" for k in TLV_METADATA_KEYS) + ']'})[p_partkey % 35 + 1]
       WHEN p_partkey % 35 + 1 >= 17 THEN p_brand END AS c1,
  CASE WHEN p_partkey % 35 + 1 <= 14 THEN p_name WHEN p_partkey % 35 + 1 >= 17 THEN p_type END AS c2,
  CAST(p_size AS VARCHAR) AS c3, CAST(p_partkey AS VARCHAR) AS c4, p_brand AS c5, p_name AS c6,
  CASE WHEN p_size > 10 THEN p_type END AS c7, CAST(p_size AS VARCHAR) AS c8,
  printf('%.2f', p_retailprice) AS c9, CAST(p_size AS VARCHAR) AS c10, 'Brand#' || CAST(p_size AS VARCHAR) AS c11,
  p_type AS c12, p_name AS c13, CASE WHEN p_size % 2 = 0 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS c14
FROM part"""

_PADDED_SQL = f"""
(SELECT r.sheet, r.row_idx, c.c1, c.c2, c.c3, c.c4, c.c5, c.c6, c.c7, c.c8, c.c9, c.c10, c.c11, c.c12, c.c13, c.c14
 FROM (SELECT sheet, CAST(unnest(range(1, 36)) AS INTEGER) AS row_idx
       FROM (SELECT DISTINCT CAST(floor(p_partkey / 35) AS BIGINT) AS sheet FROM part)) r
 LEFT JOIN ({_PART_CELLS_SQL}) c ON c.sheet = r.sheet AND c.row_idx = r.row_idx)"""


@query("quadrat_points", f"""
WITH g AS {_PADDED_SQL},
pts AS (
  SELECT sheet, row_idx, CASE WHEN row_idx <= 16 THEN 1 ELSE 3 END AS "Quadrate", c4 AS "Point", c5 AS "Code", c6 AS "Species"
  FROM g WHERE row_idx BETWEEN 1 AND 16 OR row_idx BETWEEN 19 AND 34
  UNION ALL
  SELECT sheet, row_idx, CASE WHEN row_idx <= 16 THEN 2 ELSE 4 END, c10, c11, c12
  FROM g WHERE row_idx BETWEEN 1 AND 16 OR row_idx BETWEEN 19 AND 34),
cx AS (
  SELECT sheet, CASE WHEN row_idx = 3 THEN 1 ELSE 3 END AS "Quadrate", TRY_CAST(c3 AS DOUBLE) AS "Complexity" FROM g WHERE row_idx IN (3, 21)
  UNION ALL
  SELECT sheet, CASE WHEN row_idx = 3 THEN 2 ELSE 4 END, TRY_CAST(c9 AS DOUBLE) FROM g WHERE row_idx IN (3, 21))
SELECT pts.sheet, pts.row_idx, pts."Quadrate", cx."Complexity", "Point", "Code", "Species"
FROM pts LEFT JOIN cx ON pts.sheet = cx.sheet AND pts."Quadrate" = cx."Quadrate"
""")
def quadrat_points(spark, sf):
    return grid.cover_points(grid.sheet_arrays(_part_sheets(spark, sf), ["sheet"]), ["sheet"])


@query("quadrat_counts", f"""
WITH g AS {_PADDED_SQL}
SELECT sheet, CASE WHEN row_idx <= 16 THEN 1 ELSE 3 END AS "Quadrate", c7 AS "Taxon", TRY_CAST(c8 AS DOUBLE) AS "Count"
FROM g WHERE (row_idx BETWEEN 1 AND 16 OR row_idx BETWEEN 19 AND 34) AND c7 IS NOT NULL
UNION ALL
SELECT sheet, CASE WHEN row_idx <= 16 THEN 2 ELSE 4 END, c13, TRY_CAST(c14 AS DOUBLE)
FROM g WHERE (row_idx BETWEEN 1 AND 16 OR row_idx BETWEEN 19 AND 34) AND c13 IS NOT NULL
""")
def quadrat_counts(spark, sf):
    return grid.quadrat_counts(grid.sheet_arrays(_part_sheets(spark, sf), ["sheet"]), ["sheet"])


@query("legend_block", f"""
WITH g AS {_PADDED_SQL}
SELECT sheet, row_idx, c1 AS "Code", c2 AS "Value" FROM g WHERE row_idx BETWEEN 17 AND 35
""")
def legend_block(spark, sf):
    return grid.legend(grid.sheet_arrays(_part_sheets(spark, sf), ["sheet"]), ["sheet"])


@query("invert_metadata", f"""
SELECT sheet, {', '.join(f"{canon_text(f'min_by(c2, row_idx) FILTER (WHERE c1 = {chr(39)}{k}{chr(39)})')} AS {q(k)}" for k in TLV_METADATA_KEYS)}
FROM ({_PART_CELLS_SQL}) WHERE row_idx BETWEEN 1 AND 14
GROUP BY sheet
""")
def invert_metadata_q(spark, sf):
    sheets = grid.sheet_arrays(_part_sheets(spark, sf), ["sheet"])
    return grid.invert_metadata(sheets, ["sheet"], TLV_METADATA_KEYS).drop("rows", "metadata")




# ---------------------------------------------------------------- J1, G2, G6
def _email_table(spark, sf) -> DataFrame:
    p = load(spark, sf, "part").select(
        F.concat(F.when(F.col("p_size") > 10, "P").otherwise("Q"), F.col("p_partkey").cast("string")).alias("FullName"),
        F.concat(F.regexp_replace("p_name", " ", "."), F.lit("@reef.example")).alias("email"))
    s = load(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("FullName"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lower(F.regexp_replace("s_name", "#", ".")),
                                                F.lit("@reef.example"))).alias("email"))
    return p.unionByName(s)


_EMAILS_SQL = """(SELECT CASE WHEN p_size > 10 THEN 'P' ELSE 'Q' END || CAST(p_partkey AS VARCHAR) AS "FullName",
         replace(p_name, ' ', '.') || '@reef.example' AS email
  FROM part
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_acctbal > 0 THEN lower(replace(s_name, '#', '.')) || '@reef.example' END
  FROM supplier)"""


def _pairs(spark, sf) -> DataFrame:
    li = load(spark, sf, "lineitem")
    return li.select(
        "l_partkey", "l_suppkey",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("First Observer"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("Second Observer")).distinct()


@query("email_lookup", f"""
SELECT l_partkey, l_suppkey, "First Observer" || ' and ' || "Second Observer" AS spreadsheet_name,
       {na('e1.email')} || ',' || {na('e2.email')} AS emails_text
FROM (SELECT DISTINCT l_partkey, l_suppkey, 'P' || CAST(l_partkey AS VARCHAR) AS "First Observer",
             'S' || CAST(l_suppkey AS VARCHAR) AS "Second Observer" FROM lineitem) pr
LEFT JOIN {_EMAILS_SQL} e1 ON e1."FullName" = pr."First Observer"
LEFT JOIN {_EMAILS_SQL} e2 ON e2."FullName" = pr."Second Observer"
""")
def email_lookup(spark, sf):
    pairs = _pairs(spark, sf)
    out = surveyors.with_emails(pairs, _email_table(spark, sf), ["First Observer", "Second Observer"])
    return out.select("l_partkey", "l_suppkey",
                      F.concat_ws(" and ", "First Observer", "Second Observer").alias("spreadsheet_name"),
                      F.array_join(F.col("emails"), ",", "NA").alias("emails_text"))


@query("distinct_emails", f"""
SELECT DISTINCT email FROM (
  SELECT e1.email FROM (SELECT DISTINCT l_partkey FROM lineitem) pr
    LEFT JOIN {_EMAILS_SQL} e1 ON e1."FullName" = 'P' || CAST(pr.l_partkey AS VARCHAR)
  UNION ALL
  SELECT e2.email FROM (SELECT DISTINCT l_suppkey FROM lineitem) pr
    LEFT JOIN {_EMAILS_SQL} e2 ON e2."FullName" = 'S' || CAST(pr.l_suppkey AS VARCHAR))
""")
def distinct_emails(spark, sf):
    pairs = _pairs(spark, sf)
    out = surveyors.with_emails(pairs, _email_table(spark, sf), ["First Observer", "Second Observer"])
    return surveyors.distinct_emails(out)


# ---------------------------------------------------------------- J2, J3
@query("unmatched_deployments", """
SELECT o_orderkey, 'mismatching identifier' AS "check"
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def unmatched_deployments(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return complete.unmatched_deployments(o, li, by=[], key="o_orderkey")


_COMPLETE_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, {ymd('o_orderdate')} AS o_orderdate,
       l_linenumber, l_partkey, l_suppkey, l_quantity
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
"""


@query("complete_data", _COMPLETE_SQL)
def complete_data(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         iso("o_orderdate").alias("o_orderdate"))
    li = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                                            "l_partkey", "l_suppkey", "l_quantity")
    return complete.day_complete(o, li, by=[], key="o_orderkey")


# ---------------------------------------------------------------- J5
def _segment_names_sql() -> str:
    return "[" + ", ".join(f"'{s}'" for _, s in TLV_SEGMENTS) + "]"


@query("site_number", f"""
SELECT n_nationkey, seg AS "Site", g."Site_number"
FROM (SELECT n_nationkey, CASE WHEN n_nationkey < 14 THEN {_segment_names_sql()}[n_nationkey + 1]
                               ELSE n_name END AS seg FROM nation) n
LEFT JOIN {_segments_sql()} g ON g."Segment" = n.seg
""")
def site_number(spark, sf):
    n = load(spark, sf, "nation")
    names = F.array(*[F.lit(s) for _, s in TLV_SEGMENTS])
    shaped = n.select("n_nationkey", F.when(F.col("n_nationkey") < 14,
                                            F.element_at(names, (F.col("n_nationkey") + 1).cast("int")))
                      .otherwise(F.col("n_name")).alias("Segment"))
    return traits.add_site_number(shaped).select("n_nationkey", "Site", "Site_number")


# ---------------------------------------------------------------- J6, G3-G5, J7, J8
def _legend(spark, sf) -> DataFrame:
    p = load(spark, sf, "part")
    brands = p.select("p_brand").distinct().select(
        F.concat("p_brand", F.when(F.col("p_brand") == "Brand#2", "?").otherwise("")).alias("Code"), F.concat(F.lit("Cat "), F.length("p_brand").cast("string")).alias("Value"))
    extra = spark.createDataFrame([("Brand#99", "Unused"), (None, "Blank")], "Code string, Value string")
    return brands.unionByName(extra)


@query("legend_right_join", """
SELECT p.p_partkey, coalesce(p.code, lg."Code") AS "Code", lg."Value"
FROM (SELECT p_partkey, nullif(p_brand, 'Brand#1') AS code FROM part) p
RIGHT JOIN (SELECT DISTINCT p_brand || CASE WHEN p_brand = 'Brand#2' THEN '?' ELSE '' END AS "Code",
                   'Cat ' || CAST(length(p_brand) AS VARCHAR) AS "Value"
            FROM part
            UNION ALL SELECT 'Brand#99', 'Unused' UNION ALL SELECT NULL, 'Blank') lg
  ON p.code IS NOT DISTINCT FROM lg."Code"
""")
def legend_right_join(spark, sf):
    p = load(spark, sf, "part")
    pts = p.select("p_partkey", F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("Code"))
    return cover.legend_join(pts, _legend(spark, sf), keys=[])


_COVER_CATS = ["ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE", "Sand"]
_CX = "CASE WHEN p_size > 45 THEN NULL ELSE floor(p_size / 10.0) END"


def _labelled(spark, sf) -> DataFrame:
    p = load(spark, sf, "part")
    return p.select(F.col("p_size").alias("Quadrate"),
                    F.when(F.col("p_size") > 45, None).otherwise(F.floor(F.col("p_size") / 10.0))
                    .cast("double").alias("Complexity"),
                    F.col("p_type").alias("Value"), "p_partkey", "p_name")


@query("cover_counts", f"""
SELECT p_size AS "Quadrate", CAST({_CX} AS DOUBLE) AS "Complexity", p_type AS "Value", count(*) AS n
FROM part GROUP BY 1, 2, 3
""")
def cover_counts(spark, sf):
    return cover.cover_counts(_labelled(spark, sf), keys=[])


def _cover_sql() -> str:
    cats = ", ".join(f"count(*) FILTER (WHERE p_type = '{c}') * 100.0 / 16 AS {q(c)}" for c in _COVER_CATS)
    return f"""SELECT p_size AS "Quadrate", CAST({_CX} AS DOUBLE) AS "Complexity", {cats}
FROM part GROUP BY 1, 2"""


@query("cover_percent", _cover_sql())
def cover_percent(spark, sf):
    return cover.cover_percent(_labelled(spark, sf), keys=[], categories=_COVER_CATS)


def _points_wide_sql() -> str:
    cols = ", ".join(
        f"arg_min(CAST(l_partkey AS VARCHAR), l_partkey) FILTER (WHERE l_linenumber = {i}) AS {q(str(i))}"
        for i in range(1, 8))
    return f"""SELECT l_orderkey AS "Quadrate", CAST(NULL AS DOUBLE) AS "Complexity", {cols}
FROM lineitem GROUP BY l_orderkey"""


@query("points_wide", _points_wide_sql())
def points_wide(spark, sf):
    li = load(spark, sf, "lineitem")
    pts = li.select(F.col("l_orderkey").alias("Quadrate"), F.lit(None).cast("double").alias("Complexity"),
                    F.col("l_linenumber").cast("string").alias("Point"),
                    F.col("l_partkey").cast("string").alias("Species"), F.col("l_partkey").alias("row_idx"))
    return cover.species_by_point(pts, keys=[], n_points=7)


@query("cover_taxa", f"""
SELECT c.*, t."Taxon", t."Count"
FROM ({_cover_sql()}) c
LEFT JOIN (SELECT p_size AS "Quadrate", p_name AS "Taxon", p_retailprice AS "Count" FROM part) t
  ON c."Quadrate" = t."Quadrate"
""")
def cover_taxa(spark, sf):
    cov = cover.cover_percent(_labelled(spark, sf), keys=[], categories=_COVER_CATS)
    counts = load(spark, sf, "part").select(F.col("p_size").alias("Quadrate"), F.col("p_name").alias("Taxon"),
                                            F.col("p_retailprice").alias("Count"))
    return cover.cover_with_taxa(cov, counts, keys=[])


def _species_wide_sql() -> str:
    cols = ", ".join(
        f"arg_min(p_name, p_partkey) FILTER (WHERE length(p_name) = {i}) AS {q(str(i))}" for i in range(1, 17))
    return f"""SELECT p_size AS "Quadrate", CAST({_CX} AS DOUBLE) AS "Complexity", {cols}
FROM part GROUP BY 1, 2"""


@query("cover_species", f"""
SELECT c.*, {', '.join(f's.{q(str(i))}' for i in range(1, 17))}
FROM ({_cover_sql()}) c
LEFT JOIN ({_species_wide_sql()}) s
  ON c."Quadrate" = s."Quadrate" AND c."Complexity" IS NOT DISTINCT FROM s."Complexity"
""")
def cover_species(spark, sf):
    lab = _labelled(spark, sf)
    cov = cover.cover_percent(lab, keys=[], categories=_COVER_CATS)
    pts = lab.select("Quadrate", "Complexity", F.length("p_name").cast("string").alias("Point"),
                     F.col("p_name").alias("Species"), F.col("p_partkey").alias("row_idx"))
    return cover.cover_with_species(cov, cover.species_by_point(pts, keys=[]), keys=[])


# ---------------------------------------------------------------- J9
@query("older_quadrat_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, p_name, p_size
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_returnflag = 'A'
""")
def older_quadrat_join(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size")
    return joins.conditional_left_join(li, p, ["l_partkey"], "l_returnflag", "A")


# ---------------------------------------------------------------- G1, G7
@query("deployment_lists", f"""
SELECT l_suppkey, {ymd('l_shipdate')} AS ship_day,
       string_agg(coalesce(CAST(dep AS VARCHAR), 'NA'), ',' ORDER BY l_orderkey, l_linenumber, l_partkey) AS deployments,
       count(*) AS n_deployments
FROM (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END AS dep FROM lineitem)
GROUP BY l_suppkey, l_shipdate
""")
def deployment_lists(spark, sf):
    li = load(spark, sf, "lineitem")
    shaped = li.select("l_suppkey", iso("l_shipdate").alias("ship_day"),
                       F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("pos"),
                       F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("dep"))
    out = surveyors.deployment_lists(shaped, ["l_suppkey", "ship_day"], "dep", order="pos")
    return out.select("l_suppkey", "ship_day",
                      F.array_join("deployments", ",", "NA").alias("deployments"),
                      F.size("deployments").cast("long").alias("n_deployments"))


@query("day_label", f"""
SELECT DISTINCT o_orderstatus || ' ' || {ymd('o_orderdate')} AS day_folder FROM orders
""")
def day_label_q(spark, sf):
    o = load(spark, sf, "orders")
    return o.select(day_label("o_orderstatus", "o_orderdate").alias("day_folder")).distinct()




# ---------------------------------------------------------------- U1-U3
@query("union_days", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE year(l_shipdate) <= 1996
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_tax + 0.0 AS l_tax FROM lineitem WHERE year(l_shipdate) BETWEEN 1997 AND 1998
UNION ALL BY NAME
SELECT l_orderkey, l_linenumber, l_discount + 0.0 AS l_discount, l_returnflag FROM lineitem WHERE year(l_shipdate) > 1998
""")
def union_days(spark, sf):
    li = load(spark, sf, "lineitem")
    y = F.year("l_shipdate")
    a = li.filter(y <= 1996).select("l_orderkey", "l_linenumber", "l_quantity")
    b = li.filter(y.between(1997, 1998)).select("l_orderkey", "l_linenumber", znorm("l_tax").alias("l_tax"))
    c = li.filter(y > 1998).select("l_orderkey", "l_linenumber", znorm("l_discount").alias("l_discount"),
                                   "l_returnflag")
    return complete.union_by_name([a, b, c])


# ---------------------------------------------------------------- I1-I3, A7
_STORED_BEFORE = "1998-01-01"


def _day_rows(spark, sf) -> DataFrame:
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("expedition"),
                    iso("o_orderdate").alias("day_folder"))


def _stored(spark, sf) -> DataFrame:
    return _day_rows(spark, sf).filter(F.col("day_folder") < _STORED_BEFORE)


@query("complete_days", f"""
SELECT DISTINCT o_orderpriority AS expedition, {ymd('o_orderdate')} AS day_folder
FROM orders WHERE {ymd('o_orderdate')} < '{_STORED_BEFORE}'
""")
def complete_days(spark, sf):
    return complete.complete_days(_stored(spark, sf))


@query("skip_complete", f"""
SELECT o_orderkey, o_orderpriority AS expedition, {ymd('o_orderdate')} AS day_folder,
       CASE WHEN EXISTS (SELECT 1 FROM orders s WHERE s.o_orderpriority = o.o_orderpriority
                         AND {ymd('s.o_orderdate')} = {ymd('o.o_orderdate')}
                         AND {ymd('s.o_orderdate')} < '{_STORED_BEFORE}') THEN 'stored' ELSE 'built' END AS source
FROM orders o
""")
def skip_complete(spark, sf):
    stored = _stored(spark, sf).withColumn("source", F.lit("stored"))
    todo = complete.days_to_build(_day_rows(spark, sf), stored)
    built = todo.withColumn("source", F.lit("built"))
    return complete.skip_complete(built, stored)


@query("join_days", f"""
SELECT o_orderkey, o_orderpriority AS expedition, {ymd('o_orderdate')} AS day_folder
FROM orders WHERE {ymd('o_orderdate')} < '{_STORED_BEFORE}' AND o_orderpriority = '1-URGENT'
""")
def join_days(spark, sf):
    return complete.join_days(_stored(spark, sf), "1-URGENT")


# ---------------------------------------------------------------- A8, A9
@query("prune_sources", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
""")
def prune_sources(spark, sf):
    from reefcensus.sources.lookups import prune_sources as prune
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prune(c, "c_mktsegment", skipped=["BUILDING", "MACHINERY"])


_PRUNE_SHEET_SQL = ("p_name || CASE p_type WHEN 'PROMO' THEN ' - Invertebrates' WHEN 'LARGE' THEN ' Species List' "
                    "WHEN 'SMALL' THEN ' Readme_txt' ELSE '' END")


@query("prune_sheets", f"""
SELECT p_partkey, sheet FROM (SELECT p_partkey, {_PRUNE_SHEET_SQL} AS sheet FROM part)
WHERE NOT regexp_matches(sheet, 'Invertebrates|Species List|Readme.txt|Quadrate data')
""")
def prune_sheets(spark, sf):
    from reefcensus.sources.lookups import prune_sheets as prune
    p = load(spark, sf, "part")
    suffix = (F.when(F.col("p_type") == "PROMO", " - Invertebrates").when(F.col("p_type") == "LARGE", " Species List")
              .when(F.col("p_type") == "SMALL", " Readme_txt").otherwise(""))
    return prune(p.select("p_partkey", F.concat("p_name", suffix).alias("sheet")))


# ---------------------------------------------------------------- K3
@query("backup_flag", """
SELECT o_orderkey, 'This is a local backup file and should not be used for further analyses!' AS "Flag" FROM orders
""")
def backup_flag(spark, sf):
    return with_backup_flag(load(spark, sf, "orders").select("o_orderkey"))


# ---------------------------------------------------------------- G1, J1, G2, R1-R3
_PROJECTS = [p for ps in __import__("reefcensus.registry", fromlist=["x"]).PROJECT_FAMILIES.values() for p in ps]
_JUV = ["Eilat Juveniles Transects", "Eilat Juveniles Knolls", "Eilat Juveniles Artificial"]
_PLAN_GROUP = 50  # suppliers per plan file


def _supplier_plan(spark, sf) -> DataFrame:
    """Day plans made of supplier rows: one plan per nation and block of
    suppliers, observers from the account balance, a project per nation."""
    s = load(spark, sf, "supplier")
    n = joins.broadcast_if_small(load(spark, sf, "nation"))
    projects = F.array(*[F.lit(p) for p in _PROJECTS])
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    plan = j.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string"), F.lit("-"),
                 F.floor(F.col("s_suppkey") / _PLAN_GROUP).cast("bigint").cast("string")).alias("file"),
        F.col("s_suppkey").alias("row_idx"),
        F.element_at(projects, (F.col("n_nationkey") % len(_PROJECTS) + 1).cast("int")).alias("Project"),
        F.col("n_name").alias("Location"),
        F.concat(F.lit("Obs "), F.when(F.col("s_acctbal") > 0, "A").otherwise("B")).alias("First Observer"),
        F.when(F.col("s_acctbal") > 5000, None).otherwise(F.lit("Obs C")).alias("Second Observer"),
        F.lit("Obs J").alias("Juveniles First Observer"),
        F.lit(None).cast("string").alias("Juveniles Second Observer"),
        F.col("s_suppkey").cast("string").alias("SiteID"))
    return complete.attach_family(plan)


def _plan_emails(plan: DataFrame) -> DataFrame:
    names = plan.select(F.col("First Observer").alias("FullName")).distinct()
    return names.withColumn("email", F.when(F.col("FullName") != "Obs B", F.concat(
        F.lower(F.regexp_replace("FullName", " ", ".")), F.lit("@reef.example"))))


def _plan_surveyors(spark, sf) -> DataFrame:
    plan = _supplier_plan(spark, sf)
    return surveyors.surveyor_tables(plan, _plan_emails(plan), ["file"])


def _plan_surveyor_rows(spark, sf) -> DataFrame:
    plan = _supplier_plan(spark, sf)
    return surveyors.surveyor_rows(plan, _plan_emails(plan), ["file"])


def _plan_sql() -> str:
    projects = "[" + ", ".join(f"'{p}'" for p in _PROJECTS) + "]"
    fam_rows = ", ".join(f"('{p}', '{f}')" for p, f in __import__(
        "reefcensus.registry", fromlist=["x"]).project_family_rows())
    juv = ", ".join(f"'{f}'" for f in _JUV)
    return f"""
plan0 AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) || '-' || CAST(CAST(floor(s_suppkey / {_PLAN_GROUP}) AS BIGINT) AS VARCHAR) AS file,
         s_suppkey AS row_idx, {projects}[n_nationkey % {len(_PROJECTS)} + 1] AS "Project", n_name AS loc,
         'Obs ' || CASE WHEN s_acctbal > 0 THEN 'A' ELSE 'B' END AS f1,
         CASE WHEN s_acctbal > 5000 THEN NULL ELSE 'Obs C' END AS f2,
         'Obs J' AS j1, CAST(NULL AS VARCHAR) AS j2, CAST(s_suppkey AS VARCHAR) AS dep
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
plan AS (
  SELECT plan0.*, fam.family, coalesce(fam.family IN ({juv}), false) AS juv
  FROM plan0 LEFT JOIN (SELECT * FROM (VALUES {fam_rows}) v("Project", family)) fam USING ("Project")),
em AS (SELECT DISTINCT f1 AS name, CASE WHEN f1 <> 'Obs B' THEN lower(replace(f1, ' ', '.')) || '@reef.example' END AS email FROM plan),
grp AS (
  SELECT file, row_idx, "Project", family, juv, f1, f2, dep,
         CASE WHEN juv THEN loc END AS loc, CASE WHEN juv THEN j1 END AS j1, CASE WHEN juv THEN j2 END AS j2,
         CASE WHEN juv THEN {na('f1')} || ', ' || {na('f2')} || ', ' || {na('j1')} || ', and ' || {na('j2')}
              ELSE {na('f1')} || ' and ' || {na('f2')} END AS spreadsheet_name
  FROM plan),
pos AS (
  SELECT grp.*, CAST(row_number() OVER (PARTITION BY file, "Project", f1, f2, loc, j1, j2 ORDER BY row_idx) - 1 AS INTEGER) AS dep_order
  FROM grp),
sv AS (
  SELECT file, "Project", family, juv, f1, f2, loc, j1, j2, spreadsheet_name,
         string_agg({na('dep')}, ',' ORDER BY row_idx) AS deployments, count(*) AS n_deployments
  FROM grp GROUP BY file, "Project", family, juv, f1, f2, loc, j1, j2, spreadsheet_name),
sve AS (
  SELECT sv.*, e1.email AS e1, e2.email AS e2, e3.email AS e3, e4.email AS e4
  FROM sv LEFT JOIN em e1 ON e1.name IS NOT DISTINCT FROM sv.f1
          LEFT JOIN em e2 ON e2.name IS NOT DISTINCT FROM sv.f2
          LEFT JOIN em e3 ON sv.juv AND e3.name IS NOT DISTINCT FROM sv.j1
          LEFT JOIN em e4 ON sv.juv AND e4.name IS NOT DISTINCT FROM sv.j2)"""


@query("surveyor_table", f"""
WITH {_plan_sql()}
SELECT file, "Project", family, f1 AS "First Observer", f2 AS "Second Observer", spreadsheet_name,
       deployments, n_deployments,
       {na('e1')} || ',' || {na('e2')} || CASE WHEN juv THEN ',' || {na('e3')} || ',' || {na('e4')} ELSE '' END AS emails
FROM sve
""")
def surveyor_table(spark, sf):
    sv = _plan_surveyors(spark, sf)
    return sv.select("file", "Project", "family", "First Observer", "Second Observer", "spreadsheet_name",
                     F.array_join("deployments", ",", "NA").alias("deployments"),
                     F.size("deployments").cast("long").alias("n_deployments"),
                     F.array_join("emails", ",", "NA").alias("emails"))


#: expected sheets written out: family, names in order ({} is the deployment), letters, prefilled values
_EXPECTED_SHEETS = [
    ("Tel Aviv Transects",
     "{} - B - Invertebrates, {} - B - Fish, {} - A - Invertebrates, {} - A - Fish", "BBAA", "f1 f2 dep letter"),
    ("Mediterranean Transects",
     "Site {} - Transect D, Site {} - Transect C, Site {} - Transect B, Site {} - Transect A", "DCBA", "f1 f2 dep letter"),
    ("Eilat Transects",
     "Site {} - Transect D - CRYPTIC, Site {} - Transect D - TRANSIENTS, Site {} - Transect C - CRYPTIC, "
     "Site {} - Transect C - TRANSIENTS, Site {} - Transect B - CRYPTIC, Site {} - Transect B - TRANSIENTS, "
     "Site {} - Transect A - CRYPTIC, Site {} - Transect A - TRANSIENTS", "DDCCBBAA", "f1 f2 dep letter"),
    ("Eilat Knolls", "Knoll {}", "", "f1 f2"),
    ("Eilat Juveniles Transects",
     "Site {} - Transect C - CRYPTIC, Site {} - Transect C - TRANSIENTS, Site {} - Transect C - Juveniles, "
     "Site {} - Transect B - CRYPTIC, Site {} - Transect B - TRANSIENTS, Site {} - Transect B - Juveniles, "
     "Site {} - Transect A - CRYPTIC, Site {} - Transect A - TRANSIENTS, Site {} - Transect A - Juveniles",
     "CCCBBBAAA", "f1 f2 j1 j2 'Transects' loc dep letter"),
    ("Eilat Juveniles Knolls", "Knoll {}, Juveniles - Knoll {}", "", "f1 f2 j1 j2 'Knoll' loc dep"),
    ("Eilat Juveniles Artificial", "Artificial {}, Juveniles - Artificial {}", "", "f1 f2 j1 j2 'Artificial' loc dep"),
]


def manifest_sql() -> str:
    """R1 from the names above, not from the engine's own dimension."""
    values, prefill = [], []
    for family, sheets, letters, fields in _EXPECTED_SHEETS:
        for i, sheet in enumerate(sheets.split(", ")):
            values.append(f"('{family}', {i}, '{sheet}', " + (f"'{letters[i]}'" if letters else "NULL") + ")")
        parts = [x if x.startswith("'") else na("d.letter" if x == "letter" else f"p.{x}") for x in fields.split()]
        prefill.append(f"WHEN '{family}' THEN " + " || '|' || ".join(parts))
    return f"""
WITH {_plan_sql()},
dim AS (SELECT * FROM (VALUES {', '.join(values)}) v(family, sheet_order, sheet, letter))
SELECT p.file, p.spreadsheet_name, p.dep_order, p.dep AS deployment, d.sheet_order,
       replace(d.sheet, '{{}}', {na('p.dep')}) AS sheet, CASE d.family {' '.join(prefill)} END AS prefill
FROM pos p JOIN dim d ON p.family = d.family
"""


@query("worksheet_manifest", manifest_sql())
def worksheet_manifest(spark, sf):
    m = surveyors.worksheet_manifest(_plan_surveyor_rows(spark, sf), ["file"])
    return m.select("file", "spreadsheet_name", "dep_order", "deployment", "sheet_order", "sheet",
                    F.array_join("prefill", "|", "NA").alias("prefill"))


@query("photo_manifest", f"""
WITH {_plan_sql()}
SELECT file, spreadsheet_name, deployment, letter,
       spreadsheet_name || '/' || {na('deployment')} || '/' || letter AS folder
FROM (SELECT p.file, p.spreadsheet_name, p.dep AS deployment, unnest(['A', 'B', 'C', 'D']) AS letter
      FROM pos p WHERE p.family IN ('Mediterranean Transects', 'Eilat Transects', 'Eilat Juveniles Transects'))
""")
def photo_manifest(spark, sf):
    return surveyors.photo_manifest(_plan_surveyor_rows(spark, sf), ["file"])


@query("access_list", f"""
WITH {_plan_sql()},
w AS (
  SELECT file, family, spreadsheet_name, e1 AS email FROM sve
  UNION ALL SELECT file, family, spreadsheet_name, e2 FROM sve
  UNION ALL SELECT file, family, spreadsheet_name, e3 FROM sve WHERE juv
  UNION ALL SELECT file, family, spreadsheet_name, e4 FROM sve WHERE juv),
a AS (
  SELECT file, spreadsheet_name, email, 'writer' AS role FROM w
  UNION ALL SELECT file, 'Photos/' || spreadsheet_name, email, 'writer' FROM w
    WHERE family IN ('Mediterranean Transects', 'Eilat Transects', 'Eilat Juveniles Transects')
  UNION ALL SELECT DISTINCT file, 'metadata', email, 'reader' FROM w)
SELECT a.*, CASE WHEN email IS NULL THEN 'missing email' ELSE 'grant' END AS status FROM a
""")
def access_list(spark, sf):
    return surveyors.access_list(_plan_surveyor_rows(spark, sf), ["file"])

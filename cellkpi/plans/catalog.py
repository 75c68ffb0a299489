"""Query catalogue over the driver tables: Spark plans and their SQL twins.

Every Spark query is built from the library's operators; the SQL text is an
independent DuckDB formulation of the same result (over the same parquet
tables) used as the correctness oracle. Doubles are rounded to 4 places and
timestamps rendered as 'yyyy-MM-dd HH:mm:ss' text on both sides, the format
of the reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.functions.scalars import (hour_text, round_half_away, run_uuid, sector_layer, site_from_cell,
                                       tolerant_double, ts_text, umts_sort_key)
from cellkpi.operators import select as sel
from cellkpi.operators.enrich import (ERIC_LTE_ATTRS, derive_hl_date, derive_pk, enrich,
                                      enrich_for, market_suffix, prepare_lookup)
from cellkpi.operators.spec import Item, KpiSpec, Measure, aggregate, aggregate_from_schema
from cellkpi.plans import driver_tables as dt
from cellkpi.plans.jobs import export_report, report, report_daily, with_export_key
from cellkpi.session import scratch_path
from cellkpi.sources.counters import (known_families, quarantine_unknown, read_counters,
                                      read_counters_pipe, route_file_type)
from cellkpi.sources.export import read_export, read_export_in_order
from cellkpi.sources.labels import read_labels
from cellkpi.sources.lookup import build_lookup, lookup_scan
from cellkpi.sources.schema import schema_from_fields, typed_from_strings
from cellkpi.sources.store import (filter_families, read_index, read_store, rebuild_index,
                                   scan_partitions, write_store)

RUN_TOKEN = "run-0001"          # report run token (deterministic run ids)
AS_OF = "2024-02-01"            # freshness gate reference date
FRESH_DAYS = 3
LATEST_N = 3
SCAN_DATE, SCAN_MARKET = "2024-01-15", "ASIA"
FAMILIES = ("click", "view")
REGISTERED = ("lte_click", "lte_view", "lte_purchase", "lte_signup")

# ---------------------------------------------------------------- helpers


def finish(df: DataFrame) -> DataFrame:
    """Report rendering: timestamps as text, doubles rounded to 4 places."""
    out = []
    for name, t in df.dtypes:
        c = F.col(f"`{name}`")
        if t.startswith("timestamp"):
            c = ts_text(c)
        elif t in ("double", "float"):
            c = round_half_away(name, 4)
        out.append(c.alias(name))
    return df.select(*out)


_STORES: dict = {}


def ekc(spark: SparkSession, sf: str) -> DataFrame:
    """Counters enriched with the lookup and keyed for the store."""
    e = enrich(dt.kc(spark, sf), dt.cl(spark, sf), oss_col="oss", cell_col="cell",
               lookup_cell_col="CELL", attrs=ERIC_LTE_ATTRS)
    return derive_pk(e, date_col="HL_DATE", hour_col="PERIOD_START_TIME")


def store_path(spark: SparkSession, sf: str) -> str:
    """Path of the counter store for ``sf`` (ingested once per application,
    with its partition index)."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        path = scratch_path(spark, "store")
        write_store(ekc(spark, sf), path, mode="overwrite", labels=("oss",))
        _STORES[key] = path
    return _STORES[key]


def bulk_store_path(spark: SparkSession, sf: str) -> str:
    """Path of the bulk counters' store (ingested once per application). Its rows
    spread over seven years of days, a few hundred rows each, so it has one
    directory a family and is clustered by date and hour inside."""
    key = (spark.sparkContext.applicationId, sf, "bulk")
    if key not in _STORES:
        path = scratch_path(spark, "bulk-store")
        write_store(ekl(spark, sf), path, mode="overwrite", partition_by=("pk_ft",),
                    cluster_by=("pk_date", "pk_hr", "pk_market"), with_index=False)
        _STORES[key] = path
    return _STORES[key]


def store(spark: SparkSession, sf: str) -> DataFrame:
    return read_store(spark, store_path(spark, sf))


def index(spark: SparkSession, sf: str) -> DataFrame:
    """The store's partition index table (what reports select partitions from)."""
    return read_index(spark, store_path(spark, sf))


def ekl(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk counters enriched and keyed; reports run on this live plan directly."""
    e = enrich(dt.kl(spark, sf), dt.sl(spark, sf), oss_col="oss", cell_col="cell",
               lookup_cell_col="CELL", attrs=ERIC_LTE_ATTRS)
    return derive_pk(e, date_col="HL_DATE", hour_col="PERIOD_START_TIME")


KC_SPEC = KpiSpec(
    name="kc",
    items=(
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "oss", "oss"),
        Item("PERIOD_START_TIME", "time", "PERIOD_START_TIME"),
        Item("cell", "key", "cell"),
        Measure("sum", "value", "value"),
        Measure("sum", "v_null", "v_null"),
        Measure("sum", "v_null", "v_null0", "zero"),
        Measure("max", "value", "value_max"),
        Measure("avg", "value", "value_avg"),
        Measure("sum", "cnt", "cnt"),
        Item("HL_Date_Hour", "time", "HL_DATE"),
        Item("HL_Market", "key", "HL_Market"),
        Item("HL_Cluster", "key", "HL_Cluster"),
        Item("HL_Area", "key", "HL_Area"),
    ),
    keys=("cell", "HL_Market", "HL_Cluster", "HL_Area"),
    time_keys=("HL_DATE", "PERIOD_START_TIME"),
    hour_key="HL_DATE",
)

KL_SPEC = KpiSpec(
    name="kl",
    items=(
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "oss", "oss"),
        Item("PERIOD_START_TIME", "time", "PERIOD_START_TIME"),
        Item("cell", "key", "cell"),
        Measure("sum", "l_quantity", "l_quantity"),
        Measure("sum", "l_extendedprice", "l_extendedprice"),
        Measure("max", "l_discount", "l_discount"),
        Measure("avg", "l_tax", "l_tax"),
        Item("HL_Market", "key", "HL_Market"),
    ),
    keys=("cell", "HL_Market"),
    time_keys=("HL_DATE", "PERIOD_START_TIME"),
    hour_key="HL_DATE",
)


def _w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _uuid_sql(market: str) -> str:
    h = f"md5('{RUN_TOKEN}' || '|' || {market})"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


EKC_SQL = """ekc AS (
  SELECT k.*, IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
         IFNULL(l.AREA, 'unassigned') AS HL_Area, IFNULL(l.MARKET, 'unassigned') AS pk_market,
         strftime(k.HL_DATE, '%Y-%m-%d') AS pk_date, strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM kc k LEFT JOIN cl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL)"""

EKL_SQL = """ekl AS (
  SELECT k.*, IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
         IFNULL(l.AREA, 'unassigned') AS HL_Area, IFNULL(l.MARKET, 'unassigned') AS pk_market,
         strftime(k.HL_DATE, '%Y-%m-%d') AS pk_date, strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM kl k LEFT JOIN sl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL)"""

BASE = _w(dt.KC_SQL, dt.CL_SQL, EKC_SQL)
BASE_KL = _w(dt.KL_SQL, dt.SL_SQL, EKL_SQL)

KC_MEASURES_SQL = """min(oss) AS oss, round(sum(value), 4) AS value, round(sum(v_null), 4) AS v_null,
       round(sum(ifnull(v_null, 0)), 4) AS v_null0, round(max(value), 4) AS value_max,
       round(avg(value), 4) AS value_avg, CAST(sum(cnt) AS BIGINT) AS cnt"""

IDX_SQL = "idx AS (SELECT DISTINCT pk_ft, pk_date, pk_market, pk_hr FROM ekc)"
LATEST_SQL = (f"lat AS (SELECT *, CAST(row_number() OVER (PARTITION BY pk_ft, pk_market "
              f"ORDER BY pk_date DESC, pk_hr DESC) AS INTEGER) AS hour_rank FROM idx "
              f"QUALIFY hour_rank <= {LATEST_N})")


def _kc_spec_sql(grain: str, src: str, run_id: str | None) -> str:
    rid = run_id or "'unassigned'"
    if grain == "rop":
        t1, t2 = _ts("PERIOD_START_TIME"), _ts("HL_DATE")
        keys = "HL_DATE, PERIOD_START_TIME"
        pk = "pk_ft, pk_date, pk_market, pk_hr"
    elif grain == "hour":
        t1 = t2 = _ts("HL_DATE")
        keys = "HL_DATE"
        pk = "pk_ft, pk_date, pk_market, pk_hr"
    else:
        t1 = t2 = _ts("min(date_trunc('day', HL_DATE))")
        keys = None
        pk = "pk_ft, pk_date, pk_market"
    gb = ", ".join(x for x in (keys, "cell, HL_Market, HL_Cluster, HL_Area", pk) if x)
    return (f"SELECT {rid} AS MGR_RUN_ID, {KC_MEASURES_SQL}, {t1} AS PERIOD_START_TIME, cell, "
            f"{t2} AS HL_Date_Hour, HL_Market, HL_Cluster, HL_Area, {pk}\nFROM {src}\nGROUP BY {gb}")


# ---------------------------------------------------------------- queries

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def q(name: str, sql: str | None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# -- enrichment

@q("enrich_eric_lte", BASE + """SELECT k.event_id, k.oss AS OSSName, k.cell AS EUtranCellFDD,
  IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
  IFNULL(l.AREA, 'unassigned') AS HL_Area
FROM kc k LEFT JOIN cl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL""")
def enrich_eric_lte(spark, sf):
    k = dt.kc_layout(dt.kc(spark, sf), "ericsson", "lte")
    e = enrich_for(k, dt.cl(spark, sf), "ericsson", "lte")
    return e.select("event_id", "OSSName", "EUtranCellFDD", "HL_Market", "HL_Cluster", "HL_Area")


@q("enrich_eric_umts", BASE + """SELECT k.event_id, k.oss AS OSSName, k.cell AS UtranCell,
  IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
  IFNULL(l.AREA, 'unassigned') AS HL_Area, IFNULL(l.SITE, 'unassigned') AS HL_Site
FROM kc k LEFT JOIN cl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL""")
def enrich_eric_umts(spark, sf):
    k = dt.kc_layout(dt.kc(spark, sf), "ericsson", "umts")
    e = enrich_for(k, dt.cl(spark, sf), "ericsson", "umts")
    return e.select("event_id", "OSSName", "UtranCell", "HL_Market", "HL_Cluster", "HL_Area", "HL_Site")


_NOKIA_ENRICH_SQL = """SELECT k.event_id, k.oss AS OSS, k.cell AS {cell},
  IFNULL(l.CELL, 'unassigned') AS HL_Sector, IFNULL(l.SITE, 'unassigned') AS HL_Site,
  IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
  IFNULL(l.MARKET_SUFFIX, 'unassigned') AS HL_Market_Suffix, IFNULL(l.AREA, 'unassigned') AS HL_Area
FROM kc k LEFT JOIN cl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL_UID"""
_NOKIA_OUT = ["HL_Sector", "HL_Site", "HL_Market", "HL_Cluster", "HL_Market_Suffix", "HL_Area"]


@q("enrich_nokia_lte", BASE + _NOKIA_ENRICH_SQL.format(cell="MO_DN2"))
def enrich_nokia_lte(spark, sf):
    e = enrich_for(dt.kc_layout(dt.kc(spark, sf), "nokia", "lte"), dt.cl(spark, sf), "nokia", "lte")
    return e.select("event_id", "OSS", "MO_DN2", *_NOKIA_OUT)


@q("enrich_nokia_umts", BASE + _NOKIA_ENRICH_SQL.format(cell="CELL_ID_1"))
def enrich_nokia_umts(spark, sf):
    e = enrich_for(dt.kc_layout(dt.kc(spark, sf), "nokia", "umts"), dt.cl(spark, sf), "nokia", "umts")
    return e.select("event_id", "OSS", "CELL_ID_1", *_NOKIA_OUT)


@q("enrich_cell_only", BASE + """SELECT k.event_id, k.cell,
  IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster
FROM kc k LEFT JOIN (SELECT * FROM cl WHERE TECH = 'LTE') l ON k.cell = l.CELL""")
def enrich_cell_only(spark, sf):
    """The older key variant — cell only, lookup restricted to one technology."""
    e = enrich(dt.kc(spark, sf), dt.cl(spark, sf), oss_col=None, cell_col="cell", lookup_cell_col="CELL",
               attrs={"HL_Market": "MARKET", "HL_Cluster": "CLUSTER"}, lookup_filter=F.col("TECH") == "LTE")
    return e.select("event_id", "cell", "HL_Market", "HL_Cluster")


# -- lookup (J7, S7, K3, A15, dedup)

def _lookup_two_sources(spark, sf):
    """Lookup assembled from customers and suppliers: cells 0..S-1 appear twice."""
    s = dt.sl(spark, sf).select("CELL", "OSS", "MARKET", "CLUSTER", F.lit("SUPPLIER").alias("AREA"))
    return dt.cl(spark, sf).select("CELL", "OSS", "MARKET", "CLUSTER", "AREA").unionByName(s)


@q("lookup_dedup", _w(dt.CL_SQL, dt.SL_SQL, """u AS (
  SELECT CELL, OSS, MARKET, CLUSTER, AREA FROM cl
  UNION ALL SELECT CELL, OSS, MARKET, CLUSTER, 'SUPPLIER' AS AREA FROM sl)""") + """
SELECT upper(OSS) AS oss_key, CELL AS cell, MARKET, CLUSTER, AREA FROM u
QUALIFY row_number() OVER (PARTITION BY upper(OSS), CELL
                           ORDER BY MARKET NULLS FIRST, CLUSTER NULLS FIRST, AREA NULLS FIRST) = 1""")
def lookup_dedup(spark, sf):
    lk = prepare_lookup(_lookup_two_sources(spark, sf), "CELL", ERIC_LTE_ATTRS, dedup=True)
    return lk.select(F.col("_lkey_oss").alias("oss_key"), F.col("_lkey_cell").alias("cell"),
                     F.col("_lk_MARKET").alias("MARKET"), F.col("_lk_CLUSTER").alias("CLUSTER"),
                     F.col("_lk_AREA").alias("AREA"))


_LOOKUPS: dict = {}


def _lookup_path(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LOOKUPS:
        _LOOKUPS[key] = build_lookup(dt.cl(spark, sf), scratch_path(spark, "lookup"))
    return _LOOKUPS[key]


@q("lookup_scan", _w(dt.CL_SQL) + """SELECT CELL, OSS, MARKET, CLUSTER, AREA, TECH, VENDOR FROM cl
WHERE TECH = 'LTE' AND VENDOR = 'Ericsson'""")
def lookup_scan_q(spark, sf):
    lk = lookup_scan(spark, _lookup_path(spark, sf), "LTE", "Ericsson")
    return lk.select("CELL", "OSS", "MARKET", "CLUSTER", "AREA", "TECH", "VENDOR")


@q("build_lookup", _w(dt.CL_SQL) + """SELECT TECH, VENDOR, MARKET, count(*) AS n_cells,
  count(DISTINCT MARKET_SUFFIX) AS n_suffixes FROM cl GROUP BY TECH, VENDOR, MARKET""")
def build_lookup_q(spark, sf):
    lk = spark.read.parquet(_lookup_path(spark, sf))
    return lk.groupBy("TECH", "VENDOR", "MARKET").agg(
        F.count(F.lit(1)).alias("n_cells"), F.countDistinct("MARKET_SUFFIX").alias("n_suffixes"))


@q("market_suffix", _w(dt.CL_SQL) + "SELECT DISTINCT MARKET, MARKET_SUFFIX FROM cl")
def market_suffix_q(spark, sf):
    return market_suffix(dt.cl(spark, sf))


# -- projections / scalar functions

@q("derive_pk", BASE + "SELECT event_id, pk_market, pk_date, pk_hr FROM ekc")
def derive_pk_q(spark, sf):
    return ekc(spark, sf).select("event_id", "pk_market", "pk_date", "pk_hr")


@q("derive_hl_date", _w(dt.KC_SQL) + f"""SELECT event_id, {_ts('PERIOD_START_TIME')} AS HL_Date,
  strftime(PERIOD_START_TIME, '%Y-%m-%d %H:00:00') AS HL_Date_Hour FROM kc""")
def derive_hl_date_q(spark, sf):
    return finish(derive_hl_date(dt.kc(spark, sf)).select("event_id", "HL_Date", "HL_Date_Hour"))


@q("derive_sector_layer", _w(dt.KC_SQL) + """SELECT event_id, ucell,
  CASE WHEN substring(ucell, 1, 1) = 'U' THEN 'AWS' ELSE 'PCS' END AS HL_Sectorlayer,
  '' AS HL_Sectorlayer_nokia FROM kc""")
def derive_sector_layer_q(spark, sf):
    return dt.kc(spark, sf).select("event_id", "ucell", sector_layer("ucell").alias("HL_Sectorlayer"),
                                   F.lit("").alias("HL_Sectorlayer_nokia"))


@q("derive_site", _w(dt.KC_SQL) + "SELECT event_id, ucell, 'U' || substring(ucell, 2, 8) AS HL_Site FROM kc")
def derive_site_q(spark, sf):
    return dt.kc(spark, sf).select("event_id", "ucell", site_from_cell("ucell").alias("HL_Site"))


@q("umts_sort_key", _w(dt.KC_SQL) + """SELECT event_id, ucell,
  substr(ucell, 1, 1) || substr(ucell, -1, 1) || substr(ucell, -2, 1) AS hl_umtssort FROM kc""")
def umts_sort_key_q(spark, sf):
    return dt.kc(spark, sf).select("event_id", "ucell", umts_sort_key("ucell").alias("hl_umtssort"))


# -- typing

@q("typed_from_strings", _w(dt.KC_SQL) + "SELECT event_id, try_cast(v_str AS DOUBLE) AS v_num FROM kc")
def typed_from_strings_q(spark, sf):
    raw = dt.kc(spark, sf).select(F.col("event_id").cast("string").alias("event_id"), "v_str")
    typed = typed_from_strings(raw, T.StructType([T.StructField("event_id", T.LongType()),
                                                  T.StructField("v_str", T.DoubleType())]))
    return typed.select("event_id", F.col("v_str").alias("v_num"))


# -- delimited sources

_CSV_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("OSSName", T.StringType()),
    T.StructField("EUtranCellFDD", T.StringType()), T.StructField("PERIOD_START_TIME", T.TimestampType()),
    T.StructField("value", T.DoubleType())])


def _write_delimited(df: DataFrame, path: str, sep: str) -> str:
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
       .option("timestampFormat", "yyyy-MM-dd HH:mm").csv(path))
    return path


def _kc_file_rows(spark, sf):
    k = dt.kc_layout(dt.kc(spark, sf), "ericsson", "lte")
    return k.select("event_id", "OSSName", "EUtranCellFDD", "PERIOD_START_TIME", "value")


_READ_SQL = _w(dt.KC_SQL) + f"""SELECT event_id, oss AS OSSName, cell AS EUtranCellFDD,
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, round(value, 4) AS value FROM kc"""


@q("read_counters_csv", _READ_SQL)
def read_counters_csv_q(spark, sf):
    p = _write_delimited(_kc_file_rows(spark, sf), scratch_path(spark, "csv"), ",")
    return finish(read_counters(spark, p, _CSV_SCHEMA))


@q("read_counters_pipe", _READ_SQL)
def read_counters_pipe_q(spark, sf):
    p = _write_delimited(_kc_file_rows(spark, sf), scratch_path(spark, "pipe"), "|")
    return finish(read_counters_pipe(spark, p, _CSV_SCHEMA))


@q("union_batches", _READ_SQL)
def union_batches_q(spark, sf):
    rows = _kc_file_rows(spark, sf)
    first = F.dayofmonth("PERIOD_START_TIME") <= 15
    p1 = _write_delimited(rows.where(first), scratch_path(spark, "batch-a"), ",")
    p2 = _write_delimited(rows.where(~first), scratch_path(spark, "batch-b"), ",")
    a = read_counters(spark, p1, _CSV_SCHEMA)
    b = read_counters(spark, p2, _CSV_SCHEMA)
    return finish(a.unionByName(b))


# -- family routing and quarantine

def _named(spark, sf):
    k = dt.kc(spark, sf)
    name = F.concat(F.lit("PM_NOKIA_LTE_"), F.date_format("PERIOD_START_TIME", "yyyyMMdd"), F.lit("_"),
                    F.date_format("PERIOD_START_TIME", "HHmm"), F.lit("00000_TMO_lte_"), F.col("pk_ft"),
                    F.lit(".txt"))
    return k.select("event_id", name.alias("_source_file"))


_NAMED_SQL = """named AS (
  SELECT event_id, 'PM_NOKIA_LTE_' || strftime(PERIOD_START_TIME, '%Y%m%d') || '_' ||
         strftime(PERIOD_START_TIME, '%H%M') || '00000_TMO_lte_' || pk_ft || '.txt' AS src FROM kc),
routed AS (SELECT event_id, regexp_extract(src, '^(?:[^_]*_){6}(.+?)(?:\\.[^._]*)?$', 1) AS pk_ft FROM named)"""


@q("route_file_type", _w(dt.KC_SQL, _NAMED_SQL) + "SELECT event_id, pk_ft FROM routed")
def route_file_type_q(spark, sf):
    return route_file_type(_named(spark, sf)).select("event_id", "pk_ft")


@q("quarantine_unknown", _w(dt.KC_SQL, _NAMED_SQL) + "SELECT event_id, pk_ft FROM routed WHERE pk_ft NOT IN "
   + "(" + ", ".join(f"'{t}'" for t in REGISTERED) + ")")
def quarantine_unknown_q(spark, sf):
    routed = route_file_type(_named(spark, sf)).select("event_id", "pk_ft")
    return quarantine_unknown(routed, known_families(spark, REGISTERED))


# -- store (K1, K2, S8-S10, F1, F3, F4, O1, R4)

@q("store_roundtrip", BASE + "SELECT event_id, pk_ft, pk_date, pk_market, pk_hr, round(value, 4) AS value, "
   "HL_Cluster, HL_Area FROM ekc")
def store_roundtrip_q(spark, sf):
    return finish(store(spark, sf).select("event_id", "pk_ft", "pk_date", "pk_market", "pk_hr", "value",
                                          "HL_Cluster", "HL_Area"))


@q("store_scan_pruned", BASE + f"""SELECT event_id, pk_ft, pk_hr, cell, round(value, 4) AS value FROM ekc
WHERE pk_date = '{SCAN_DATE}' AND pk_market = '{SCAN_MARKET}'""")
def store_scan_pruned_q(spark, sf):
    s = scan_partitions(store(spark, sf), pk_date=SCAN_DATE, pk_market=SCAN_MARKET)
    return finish(s.select("event_id", "pk_ft", "pk_hr", "cell", "value"))


@q("partition_index", BASE + "SELECT DISTINCT pk_ft, pk_date, pk_market, pk_hr FROM ekc")
def partition_index_q(spark, sf):
    return sel.ordered_index(index(spark, sf))


@q("partition_row_counts", BASE + """SELECT pk_ft, pk_date, pk_market, pk_hr, count(*) AS n_rows
FROM ekc GROUP BY pk_ft, pk_date, pk_market, pk_hr""")
def partition_row_counts(spark, sf):
    """The index table as written by the ingest: keys and row counts."""
    return index(spark, sf).select("pk_ft", "pk_date", "pk_market", "pk_hr", "n_rows")


@q("partition_index_rebuilt", BASE + """SELECT pk_ft, pk_date, pk_market, pk_hr, count(*) AS n_rows
FROM ekc GROUP BY pk_ft, pk_date, pk_market, pk_hr""")
def partition_index_rebuilt(spark, sf):
    """Store written without an index, index rebuilt from one scan (repair path)."""
    path = scratch_path(spark, "store-noindex")
    write_store(ekc(spark, sf), path, mode="overwrite", with_index=False)
    rebuild_index(spark, path)
    return read_index(spark, path).select("pk_ft", "pk_date", "pk_market", "pk_hr", "n_rows")

@q("filter_families", BASE + """SELECT pk_ft, pk_market, count(*) AS n_rows, round(sum(value), 4) AS value
FROM ekc WHERE pk_ft IN ('click', 'view') GROUP BY pk_ft, pk_market""")
def filter_families_q(spark, sf):
    s = filter_families(store(spark, sf), "|".join(FAMILIES))
    return finish(s.groupBy("pk_ft", "pk_market").agg(F.count(F.lit(1)).alias("n_rows"),
                                                      F.sum("value").alias("value")))


# -- aggregates

def _hourly_by_cell(df: DataFrame, *aggs) -> DataFrame:
    return finish(df.groupBy("cell", hour_text("HL_DATE").alias("hl_hour")).agg(*aggs))


_HOURLY_SQL = _w(dt.KC_SQL) + """SELECT cell, strftime(HL_DATE, '%Y-%m-%d %H:00:00') AS hl_hour, {aggs}
FROM kc GROUP BY cell, strftime(HL_DATE, '%Y-%m-%d %H:00:00')"""


@q("agg_sum", _HOURLY_SQL.format(aggs="round(sum(v_null), 4) AS v_null"))
def agg_sum(spark, sf):
    return _hourly_by_cell(dt.kc(spark, sf), Measure("sum", "v_null").column())


@q("agg_sum_null0", _HOURLY_SQL.format(aggs="round(sum(ifnull(v_null, 0)), 4) AS v_null"))
def agg_sum_null0(spark, sf):
    return _hourly_by_cell(dt.kc(spark, sf), Measure("sum", "v_null", null_policy="zero").column())


@q("agg_max", _w(dt.KC_SQL) + """SELECT cell, pk_ft, round(max(try_cast(v_str AS DOUBLE)), 4) AS v_str
FROM kc GROUP BY cell, pk_ft""")
def agg_max(spark, sf):
    k = dt.kc(spark, sf)
    return finish(k.groupBy("cell", "pk_ft").agg(Measure("max", "v_str").column(dict(k.dtypes))))


@q("agg_max_null0", _HOURLY_SQL.format(aggs="round(max(ifnull(v_null, 0)), 4) AS v_null"))
def agg_max_null0(spark, sf):
    return _hourly_by_cell(dt.kc(spark, sf), Measure("max", "v_null", null_policy="zero").column())


@q("agg_avg", _w(dt.KC_SQL) + "SELECT cell, round(avg(value), 4) AS value FROM kc GROUP BY cell")
def agg_avg(spark, sf):
    return finish(dt.kc(spark, sf).groupBy("cell").agg(Measure("avg", "value").column()))


@q("agg_min_label", _w(dt.KC_SQL) + "SELECT cell, min(oss) AS oss, min(pk_ft) AS pk_ft FROM kc GROUP BY cell")
def agg_min_label(spark, sf):
    return dt.kc(spark, sf).groupBy("cell").agg(Measure("min", "oss").column(), Measure("min", "pk_ft").column())


@q("agg_count", _w(dt.KC_SQL) + "SELECT pk_ft, count(*) AS n_rows FROM kc GROUP BY pk_ft")
def agg_count(spark, sf):
    return dt.kc(spark, sf).groupBy("pk_ft").agg(Measure("count", "*", "n_rows").column())


@q("agg_shared_alias", _w(dt.KC_SQL) + """SELECT cell, round(sum(ifnull(value, 0)), 4) AS value,
  round(sum(ifnull(value, 0)), 4) AS value_gcr FROM kc GROUP BY cell""")
def agg_shared_alias(spark, sf):
    k = dt.kc(spark, sf)
    spec = KpiSpec(name="shared", items=(Item("cell", "key", "cell"),
                                         Measure("sum", "value", "value", "zero"),
                                         Measure("sum", "value", "value_gcr", "zero")), keys=("cell",))
    return finish(aggregate(k, spec, grain="day", extra_keys=()))


AGG_SCHEMA = schema_from_fields([
    {"name": "cell", "type": "string", "nullable": True, "metadata": {}, "agg": "cell"},
    {"name": "oss", "type": "string", "nullable": True, "metadata": {}, "agg": "MIN"},
    {"name": "l_quantity", "type": "double", "nullable": True, "metadata": {}, "agg": "SUM"},
    {"name": "l_extendedprice", "type": "double", "nullable": True, "metadata": {}, "agg": "SUM"},
    {"name": "l_discount", "type": "double", "nullable": True, "metadata": {}, "agg": "MAX"},
    {"name": "l_tax", "type": "double", "nullable": True, "metadata": {}, "agg": "MIN"},
    {"name": "l_returnflag", "type": "string", "nullable": True, "metadata": {}, "agg": "EXCLUDE"},
    {"name": "l_linenumber", "type": "integer", "nullable": True, "metadata": {}},
])


@q("agg_from_schema", _w(dt.KL_SQL) + """SELECT cell, min(oss) AS oss, round(sum(l_quantity), 4) AS l_quantity,
  round(sum(l_extendedprice), 4) AS l_extendedprice, round(max(l_discount), 4) AS l_discount,
  round(min(l_tax), 4) AS l_tax FROM kl GROUP BY cell""")
def agg_from_schema(spark, sf):
    return finish(aggregate_from_schema(dt.kl(spark, sf), AGG_SCHEMA))


# -- KPI grains

@q("kpi_rop", BASE + _kc_spec_sql("rop", "ekc", None))
def kpi_rop(spark, sf):
    return finish(aggregate(store(spark, sf), KC_SPEC, grain="rop"))


@q("kpi_rop_label_split", BASE + _kc_spec_sql("rop", "ekc", None))
def kpi_rop_label_split(spark, sf):
    """A7 with labels as codes of the store's dictionary (one scan, one hash aggregate)."""
    return finish(aggregate(store(spark, sf), KC_SPEC, grain="rop", labels=read_labels(spark, store_path(spark, sf))))


@q("kpi_hourly", BASE + _kc_spec_sql("hour", "ekc", None))
def kpi_hourly(spark, sf):
    return finish(aggregate(store(spark, sf), KC_SPEC, grain="hour"))


@q("daily_rollup", BASE + _kc_spec_sql("day", "ekc", None))
def daily_rollup(spark, sf):
    return finish(aggregate(store(spark, sf), KC_SPEC, grain="day"))


@q("hour_day_grouping_sets", BASE + """SELECT pk_date, pk_hr, cell, HL_Market,
  CASE WHEN grouping(pk_hr) = 1 THEN 'day' ELSE 'hour' END AS grain,
  round(sum(value), 4) AS value, CAST(sum(cnt) AS BIGINT) AS cnt, round(max(value), 4) AS value_max
FROM ekc GROUP BY GROUPING SETS ((pk_date, pk_hr, cell, HL_Market), (pk_date, cell, HL_Market))""")
def hour_day_grouping_sets(spark, sf):
    s = store(spark, sf)
    g = s.groupingSets([["pk_date", "pk_hr", "cell", "HL_Market"], ["pk_date", "cell", "HL_Market"]],
                       "pk_date", "pk_hr", "cell", "HL_Market").agg(
        F.when(F.grouping("pk_hr") == 1, F.lit("day")).otherwise(F.lit("hour")).alias("grain"),
        F.sum("value").alias("value"), F.sum("cnt").alias("cnt"), F.max("value").alias("value_max"))
    return finish(g)


@q("vector_counter_sum", _w(dt.KL_SQL) + "SELECT cell, " + ", ".join(
    f"CAST(sum(qbin_{i}) AS BIGINT) AS qbin_{i}" for i in range(dt.QTY_BINS))
   + ", CAST(" + " + ".join(f"sum(qbin_{i})" for i in range(dt.QTY_BINS)) + " AS BIGINT) AS qbin_total"
   + " FROM kl GROUP BY cell")
def vector_counter_sum(spark, sf):
    from cellkpi.operators.aggregate import vector_sum
    v = vector_sum(dt.kl(spark, sf), "qbin", dt.QTY_BINS, keys=["cell"])
    return v.select("cell", *[F.col("qbin")[i].alias(f"qbin_{i}") for i in range(dt.QTY_BINS)],
                    F.aggregate("qbin", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("qbin_total"))


# -- partition selection

@q("latest_n_hours", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL
   + "\nSELECT pk_ft, pk_date, pk_market, pk_hr, hour_rank FROM lat")
def latest_n_hours(spark, sf):
    return sel.latest_hours(index(spark, sf), LATEST_N)


@q("latest_n_hours_latest_day", BASE.rstrip("\n") + ",\n" + IDX_SQL + f""",
md AS (SELECT *, max(pk_date) OVER (PARTITION BY pk_ft, pk_market) AS maxd FROM idx)
SELECT pk_ft, pk_date, pk_market, pk_hr,
  CAST(row_number() OVER (PARTITION BY pk_ft, pk_market ORDER BY pk_hr DESC) AS INTEGER) AS hour_rank
FROM md WHERE pk_date = maxd QUALIFY hour_rank <= {LATEST_N}""")
def latest_n_hours_latest_day(spark, sf):
    return sel.latest_hours_latest_day(index(spark, sf), LATEST_N)


@q("latest_date_per_market", BASE + "SELECT pk_ft, pk_market, max(pk_date) AS latest_date FROM ekc "
   "GROUP BY pk_ft, pk_market")
def latest_date_per_market(spark, sf):
    return sel.latest_date_per_market(index(spark, sf))


@q("max_hour_across_families", BASE + "SELECT pk_date, pk_market, max(pk_hr) AS max_hr FROM ekc "
   "GROUP BY pk_date, pk_market")
def max_hour_across_families(spark, sf):
    return sel.max_hour_across_families(index(spark, sf))


@q("latest_dates_semi", BASE.rstrip("\n") + """,
top AS (SELECT DISTINCT pk_date FROM ekc ORDER BY pk_date DESC LIMIT 2)
SELECT DISTINCT t1.pk_date, t1.pk_market, t1.pk_hr FROM ekc t1 JOIN top t2 ON t1.pk_date = t2.pk_date""")
def latest_dates_semi(spark, sf):
    rows = sel.rows_in_latest_dates(store(spark, sf), 2, index=index(spark, sf))
    return rows.select("pk_date", "pk_market", "pk_hr").distinct()


# -- report, run id, export

REPORT_SQL = (BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + """,
sel AS (SELECT e.* FROM ekc e SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr))
""" + _kc_spec_sql("hour", "sel", f"pk_hr || '-' || {_uuid_sql('pk_market')}"))


@q("kpi_report", REPORT_SQL)
def kpi_report(spark, sf):
    return finish(report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", run_token=RUN_TOKEN,
                         index=index(spark, sf)))


@q("kpi_report_daily", BASE.rstrip("\n") + """,
ld AS (SELECT pk_ft, pk_market, max(pk_date) AS pk_date FROM ekc GROUP BY pk_ft, pk_market),
sel AS (SELECT e.* FROM ekc e SEMI JOIN ld USING (pk_ft, pk_market, pk_date))
""" + _kc_spec_sql("day", "sel", f"'24-' || {_uuid_sql('pk_market')}"))
def kpi_report_daily(spark, sf):
    return finish(report_daily(store(spark, sf), KC_SPEC, run_token=RUN_TOKEN, index=index(spark, sf)))


@q("stamp_run_id", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL
   + f"\nSELECT DISTINCT pk_ft, pk_market, pk_hr, pk_hr || '-' || {_uuid_sql('pk_market')} AS MGR_RUN_ID FROM lat")
def stamp_run_id(spark, sf):
    r = report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", run_token=RUN_TOKEN,
               index=index(spark, sf))
    return r.select("pk_ft", "pk_market", "pk_hr", "MGR_RUN_ID").distinct()


_EXPORT_KEY_SQL = (BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + """,
ms AS (SELECT MARKET, min(MARKET_SUFFIX) AS sfx FROM cl GROUP BY MARKET),
keys AS (SELECT l.pk_ft, l.pk_date, l.pk_market, l.pk_hr, IFNULL(ms.sfx, 'null') AS market_suffix,
    'kpiagg_' || l.pk_date || '_' || lower(IFNULL(ms.sfx, 'null')) || '_' || upper(replace(l.pk_market, ' ', '-'))
    || '_' || l.pk_hr || '_' || replace(l.pk_ft, '_', '-') AS export_key
  FROM lat l LEFT JOIN ms ON l.pk_market = ms.MARKET)
""")


@q("export_key", _EXPORT_KEY_SQL + "SELECT * FROM keys")
def export_key_q(spark, sf):
    r = report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", run_token=RUN_TOKEN,
               index=index(spark, sf))
    k = with_export_key(r, dt.cl(spark, sf))
    return k.select("pk_ft", "pk_date", "pk_market", "pk_hr", "market_suffix", "export_key").distinct()


@q("export_csv", _EXPORT_KEY_SQL + """, rows AS (
  SELECT pk_ft, pk_date, pk_market, pk_hr, count(*) AS n FROM (
    SELECT pk_ft, pk_date, pk_market, pk_hr, cell, HL_DATE, HL_Market, HL_Cluster, HL_Area
    FROM ekc SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr)
    GROUP BY ALL) GROUP BY ALL)
SELECT k.export_key, r.n AS n_rows FROM keys k JOIN rows r USING (pk_ft, pk_date, pk_market, pk_hr)""")
def export_csv_q(spark, sf):
    r = report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", run_token=RUN_TOKEN,
               index=index(spark, sf))
    path = export_report(with_export_key(finish(r), dt.cl(spark, sf)), scratch_path(spark, "export"))
    back = read_export(spark, path)
    return back.groupBy("export_key").agg(F.count(F.lit(1)).alias("n_rows"))


@q("freshness_gate", BASE + f"""SELECT pk_ft, pk_market, max(pk_date) AS latest_date,
  CAST(date_diff('day', CAST(max(pk_date) AS DATE), DATE '{AS_OF}') AS INTEGER) AS age_days,
  date_diff('day', CAST(max(pk_date) AS DATE), DATE '{AS_OF}') < {FRESH_DAYS} AS is_fresh
FROM ekc GROUP BY pk_ft, pk_market""")
def freshness_gate(spark, sf):
    return sel.fresh_markets(index(spark, sf), AS_OF, FRESH_DAYS)


# -- late data, batch equivalent of the streaming hourly aggregate (R2)

@q("tumbling_hour_batch", _w(dt.KC_SQL) + f"""SELECT {_ts("time_bucket(INTERVAL '1 hour', PERIOD_START_TIME)")} AS window_start,
  cell, round(sum(value), 4) AS value, CAST(count(*) AS BIGINT) AS n_rows
FROM kc GROUP BY time_bucket(INTERVAL '1 hour', PERIOD_START_TIME), cell""")
def tumbling_hour_batch(spark, sf):
    from cellkpi.streaming.hourly import hourly_window_agg
    return finish(hourly_window_agg(dt.kc(spark, sf)))


# -- bulk counters through the whole pipeline (bench scale)

@q("kpi_bulk_report", BASE_KL.rstrip("\n") + f""",
idx AS (SELECT DISTINCT pk_ft, pk_date, pk_market, pk_hr FROM ekl),
lat AS (SELECT *, row_number() OVER (PARTITION BY pk_ft, pk_market ORDER BY pk_date DESC, pk_hr DESC) AS rk
        FROM idx QUALIFY rk <= {LATEST_N}),
sel AS (SELECT e.* FROM ekl e SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr))
SELECT pk_hr || '-' || {_uuid_sql('pk_market')} AS MGR_RUN_ID, min(oss) AS oss,
  {_ts('HL_DATE')} AS PERIOD_START_TIME, cell, round(sum(l_quantity), 4) AS l_quantity,
  round(sum(l_extendedprice), 4) AS l_extendedprice, round(max(l_discount), 4) AS l_discount,
  round(avg(l_tax), 4) AS l_tax, HL_Market, pk_ft, pk_date, pk_market, pk_hr
FROM sel GROUP BY HL_DATE, cell, HL_Market, pk_ft, pk_date, pk_market, pk_hr""")
def kpi_bulk_report(spark, sf):
    # hours are chosen from the key columns of the written store, not from a second enrichment
    return finish(report(read_store(spark, bulk_store_path(spark, sf)), KL_SPEC, latest_n=LATEST_N, grain="hour",
                         run_token=RUN_TOKEN))


@q("kpi_bulk_hourly", BASE_KL + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(oss) AS oss,
  {_ts('HL_DATE')} AS PERIOD_START_TIME, cell, round(sum(l_quantity), 4) AS l_quantity,
  round(sum(l_extendedprice), 4) AS l_extendedprice, round(max(l_discount), 4) AS l_discount,
  round(avg(l_tax), 4) AS l_tax, HL_Market, pk_ft, pk_date, pk_market, pk_hr
FROM ekl GROUP BY HL_DATE, cell, HL_Market, pk_ft, pk_date, pk_market, pk_hr""")
def kpi_bulk_hourly(spark, sf):
    return finish(aggregate(ekl(spark, sf), KL_SPEC, grain="hour"))


# -- more store / export / spec paths

SCAN_HOUR = "07"


@q("store_scan_hour", BASE + f"""SELECT event_id, pk_ft, pk_date, pk_market, round(value, 4) AS value FROM ekc
WHERE pk_hr = '{SCAN_HOUR}'""")
def store_scan_hour(spark, sf):
    s = scan_partitions(store(spark, sf), pk_hr=int(SCAN_HOUR))
    return finish(s.select("event_id", "pk_ft", "pk_date", "pk_market", "value"))


@q("export_merged_hours", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + """
SELECT pk_date, pk_market, pk_ft, count(*) AS n_rows, max(pk_hr) AS first_hour, min(pk_hr) AS last_hour, 0::BIGINT AS out_of_order FROM (
  SELECT pk_ft, pk_date, pk_market, pk_hr, cell, HL_DATE, HL_Market, HL_Cluster, HL_Area
  FROM ekc SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr) GROUP BY ALL)
GROUP BY pk_date, pk_market, pk_ft""")
def export_merged_hours(spark, sf):
    """One folder per (date, market, family), newest hour first over all its parts."""
    r = report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", run_token=RUN_TOKEN,
               index=index(spark, sf))
    path = export_report(with_export_key(finish(r), dt.cl(spark, sf)), scratch_path(spark, "export-merged"),
                         merge_hours=True)
    back, keys = read_export_in_order(spark, path), ["pk_date", "pk_market", "pk_ft"]
    parts = back.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line", "pk_hr")).alias("head"),
                                            F.max(F.struct("line", "pk_hr")).alias("tail"), F.max("pk_hr").alias("hi"), F.min("pk_hr").alias("lo"))
    # in order: a part runs from its newest to its oldest hour, and on from the part before
    before = F.lag("lo").over(Window.partitionBy(*keys).orderBy("part"))
    wrong = ((F.col("head.pk_hr") != F.col("hi")) | (F.col("tail.pk_hr") != F.col("lo")) | (before < F.col("hi"))).cast("long")
    return (parts.withColumn("wrong", F.coalesce(wrong, F.lit(0))).groupBy(*keys)
            .agg(F.sum("n").alias("n_rows"), F.max("hi").alias("first_hour"), F.min("lo").alias("last_hour"), F.sum("wrong").alias("out_of_order")))


KC_TEXT_SELECT = ("'unassigned' as MGR_RUN_ID, min(oss) as oss, HL_DATE as PERIOD_START_TIME, cell, "
                  "sum(value) as value, sum(v_null) as v_null, SUM(IFNULL(v_null,0)) as v_null0, "
                  "max(value) as value_max, avg(value) as value_avg, sum(cnt) as cnt, HL_DATE as HL_Date_Hour, "
                  "HL_Market, HL_Cluster, HL_Area")
KC_TEXT_GROUPBY = "HL_DATE, cell, HL_Market, HL_Cluster, HL_Area"


@q("kpi_report_sql_spec", REPORT_SQL)
def kpi_report_sql_spec(spark, sf):
    from cellkpi.plans.jobs import report_sql
    r = report_sql(store(spark, sf), KC_TEXT_SELECT, KC_TEXT_GROUPBY, latest_n=LATEST_N, run_token=RUN_TOKEN,
                   index=index(spark, sf))
    return finish(r)


@q("lookup_no_dedup", _w(dt.KC_SQL, dt.CL_SQL, dt.SL_SQL, """u AS (
  SELECT CELL, OSS, MARKET, CLUSTER, AREA FROM cl
  UNION ALL SELECT CELL, OSS, MARKET, CLUSTER, 'SUPPLIER' AS AREA FROM sl)""") + """
SELECT k.cell, IFNULL(u.MARKET, 'unassigned') AS HL_Market, count(*) AS n_rows, round(sum(k.value), 4) AS value
FROM kc k LEFT JOIN u ON upper(k.oss) = upper(u.OSS) AND k.cell = u.CELL
GROUP BY k.cell, IFNULL(u.MARKET, 'unassigned')""")
def lookup_no_dedup(spark, sf):
    e = enrich(dt.kc(spark, sf), _lookup_two_sources(spark, sf), oss_col="oss", cell_col="cell",
               lookup_cell_col="CELL", attrs={"HL_Market": "MARKET"}, dedup_lookup=False)
    return finish(e.groupBy("cell", "HL_Market").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value")))


@q("quarantine_bad_periods", _w(dt.KC_SQL) + """SELECT
  CASE WHEN v_str = 'x' THEN 'quarantine' ELSE 'store' END AS route, pk_ft, count(*) AS n_rows
FROM kc GROUP BY 1, 2""")
def quarantine_bad_periods(spark, sf):
    from cellkpi.sources.counters import split_bad_periods
    k = dt.kc_layout(dt.kc(spark, sf), "ericsson", "lte")
    text = F.when(F.col("v_str") == "x", F.lit("not a time")).otherwise(
        F.date_format("PERIOD_START_TIME", "yyyy-MM-dd HH:mm"))
    rows = k.select("event_id", "pk_ft", text.alias("PERIOD_START_TIME"), "value")
    p = scratch_path(spark, "dirty-csv")
    rows.write.mode("overwrite").option("header", True).csv(p)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("pk_ft", T.StringType()),
                           T.StructField("PERIOD_START_TIME", T.TimestampType()),
                           T.StructField("value", T.DoubleType())])
    good, bad = split_bad_periods(read_counters(spark, p, schema))
    return (good.select(F.lit("store").alias("route"), "pk_ft")
            .unionByName(bad.select(F.lit("quarantine").alias("route"), "pk_ft"))
            .groupBy("route", "pk_ft").agg(F.count(F.lit(1)).alias("n_rows")))


@q("dedup_redelivered", _w(dt.KC_SQL) + """SELECT pk_ft, count(*) AS n_rows,
  round(sum(CASE WHEN event_id % 5 = 0 THEN value * 2 ELSE value END), 4) AS value,
  CAST(2 * count(*) AS BIGINT) AS deliveries
FROM kc GROUP BY pk_ft""")
def dedup_redelivered(spark, sf):
    """Q12: the whole table delivered twice, the second delivery with corrected
    values; one row per record survives (the last delivery)."""
    from cellkpi.operators.enrich import dedup_rows
    k = dt.kc(spark, sf).select("event_id", "pk_ft", "cell", "PERIOD_START_TIME", "value")
    fixed = F.when(F.col("event_id") % 5 == 0, F.col("value") * 2).otherwise(F.col("value"))
    first = k.withColumn("_delivery", F.lit(1))
    again = k.withColumn("value", fixed).withColumn("_delivery", F.lit(2))
    d = dedup_rows(first.unionByName(again), ["pk_ft", "event_id"], ["_delivery"], keep="last")
    return finish(d.groupBy("pk_ft").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value"),
                                         F.sum("_delivery").cast("bigint").alias("deliveries")))


_LANDING_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("OSSName", T.StringType()),
    T.StructField("EUtranCellFDD", T.StringType()), T.StructField("PERIOD_START_TIME", T.TimestampType()),
    T.StructField("HL_DATE", T.TimestampType()), T.StructField("value", T.DoubleType()),
    T.StructField("pk_ft", T.StringType())])


@q("landing_stream", BASE + """SELECT pk_ft, pk_date, pk_market, count(*) AS n_rows, round(sum(value), 4) AS value
FROM ekc GROUP BY pk_ft, pk_date, pk_market""")
def landing_stream(spark, sf):
    """Counter files (one folder per family) landed by Structured Streaming
    in several micro-batches (file-source checkpoint, availableNow), enriched
    and written with their index; the landed store equals the batch pipeline."""
    from cellkpi.streaming.landing import land
    rows = dt.kc_layout(dt.kc(spark, sf), "ericsson", "lte").select(*[f.name for f in _LANDING_SCHEMA.fields])
    src, store_p = scratch_path(spark, "landing-src"), scratch_path(spark, "landing-store")
    (rows.hint("rebalance", "pk_ft").write.partitionBy("pk_ft").option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm")
         .csv(src))
    q_ = land(spark, src, _LANDING_SCHEMA, dt.cl(spark, sf), store_p, scratch_path(spark, "landing-ckpt"),
              enrich_kw=dict(oss_col="OSSName", cell_col="EUtranCellFDD", lookup_cell_col="CELL",
                             attrs=ERIC_LTE_ATTRS, date_col="HL_DATE", hour_col="PERIOD_START_TIME"),
              family_from="column", max_files_per_trigger=4)
    q_.awaitTermination()
    if q_.exception() is not None:
        raise RuntimeError(str(q_.exception()))
    landed = read_store(spark, store_p)
    return finish(landed.groupBy("pk_ft", "pk_date", "pk_market").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value")))


STREAM_LATENESS = "31 days"     # the driver tables span one month: no row is too late


@q("tumbling_hour_stream", _w(dt.KC_SQL) + f"""SELECT {_ts("time_bucket(INTERVAL '1 hour', PERIOD_START_TIME)")} AS window_start,
  cell, round(sum(value), 4) AS value, CAST(count(*) AS BIGINT) AS n_rows
FROM kc GROUP BY time_bucket(INTERVAL '1 hour', PERIOD_START_TIME), cell""")
def tumbling_hour_stream(spark, sf):
    """R2 as a stream: counter files (one folder per family, so every later
    micro-batch revisits hours of earlier ones) -> watermarked hourly windows
    in update mode -> window log -> newest version per window."""
    from cellkpi.streaming.hourly import hourly_window_updates, read_current_windows
    rows = dt.kc(spark, sf).select("pk_ft", "cell", "PERIOD_START_TIME", "value")
    src = scratch_path(spark, "hourly-src")
    rows.hint("rebalance", "pk_ft").write.partitionBy("pk_ft").parquet(src)      # files by size, not one a task and family
    schema = T.StructType([T.StructField("cell", T.StringType()), T.StructField("PERIOD_START_TIME", T.TimestampType()),
                           T.StructField("value", T.DoubleType()), T.StructField("pk_ft", T.StringType())])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = scratch_path(spark, "hourly-log")
    q_ = hourly_window_updates(stream, out, scratch_path(spark, "hourly-ckpt"), lateness=STREAM_LATENESS)
    q_.awaitTermination()
    if q_.exception() is not None:
        raise RuntimeError(str(q_.exception()))
    return finish(read_current_windows(spark, out))


# -- vendor family specs (E1-E4, N7, N9, N14, M11) register themselves here
from cellkpi.plans import delivery_catalog, family_catalog, ledger_catalog, rollup_catalog, store_catalog, vector_catalog  # noqa: E402,F401

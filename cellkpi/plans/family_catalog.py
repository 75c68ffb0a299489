"""Catalogue entries for the vendor family specs (E1-E4, all Nokia LTE and UMTS families, N9 also at its hl_date grain).

Each query runs a family spec from ``plans.families`` unchanged — the rule
expands over the vendor layout's columns — through the same enrichment,
partition keys and single ``groupBy().agg()`` the jobs use. The SQL twins
are written out by hand, item by item, so they check the spec compiler
(null policies, renames, second aliases, floors, tolerant casts, labels,
keys and time stamps per grain) rather than repeat it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.operators.aggregate import deal_groups
from cellkpi.operators.enrich import derive_hl_date, derive_pk, enrich_for
from cellkpi.operators.spec import aggregate, parse_sql_features, sql_feature_aggregate
from cellkpi.plans import driver_tables as dt
from cellkpi.plans import families as fam
from cellkpi.plans import vendor_tables as vt
from cellkpi.plans.catalog import _w, finish, q
from cellkpi.session import compile_wide_plans, scratch_path, write_text_file
from cellkpi.sources.labels import label_texts
from cellkpi.sources.schema import IDENTITY, SchemaRegistry
from cellkpi.sources.vectors import pack_vectors


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _day(x: str) -> str:
    return _ts(f"min(date_trunc('day', {x}))")


def _r(expr: str, alias: str) -> str:
    return f"round({expr}, 4) AS {alias}"


def _sum0(c: str, alias: str | None = None) -> str:
    return _r(f"sum(ifnull({c}, 0))", alias or c)


def _sum(c: str, alias: str | None = None) -> str:
    return _r(f"sum({c})", alias or c)


# ------------------------------------------------------------------ Ericsson

def _eric_pk(rows: DataFrame) -> DataFrame:
    return derive_pk(rows, date_col="HL_DATE", hour_col="PERIOD_START_TIME")


def _eric_lte_unkeyed(spark, sf) -> DataFrame:
    return enrich_for(vt.eric_lte_rows(spark, sf), dt.sl(spark, sf), "ericsson", "lte")


def _eric_umts_unkeyed(spark, sf) -> DataFrame:
    return enrich_for(vt.eric_umts_rows(spark, sf), vt.umts_lookup(spark, sf), "ericsson", "umts")


def _eric_lte(spark, sf) -> DataFrame:
    return _eric_pk(_eric_lte_unkeyed(spark, sf))


def _eric_umts(spark, sf) -> DataFrame:
    return _eric_pk(_eric_umts_unkeyed(spark, sf))


_ERIC_LTE_ENRICHED_SQL = """e AS (
  SELECT k.* EXCLUDE (HL_MARKET), IFNULL(l.MARKET, 'unassigned') AS HL_Market,
         IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster, IFNULL(l.AREA, 'unassigned') AS HL_Area,
         strftime(k.HL_DATE, '%Y-%m-%d') AS pk_date, strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM {src} k LEFT JOIN sl l ON upper(k.OSSName) = upper(l.OSS) AND k.EUtranCellFDD = l.CELL)"""

_ERIC_UMTS_ENRICHED_SQL = """e AS (
  SELECT k.* EXCLUDE (HL_MARKET), IFNULL(l.MARKET, 'unassigned') AS HL_Market,
         IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster, IFNULL(l.AREA, 'unassigned') AS HL_Area,
         IFNULL(l.SITE, 'unassigned') AS HL_Site,
         strftime(k.HL_DATE, '%Y-%m-%d') AS pk_date, strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM eu k LEFT JOIN ul l ON upper(k.OSSName) = upper(l.OSS) AND k.UtranCell = l.CELL)"""

ERIC_LTE_BASE = _w(dt.KL_SQL, dt.SL_SQL, vt.ERIC_LTE_SQL, _ERIC_LTE_ENRICHED_SQL.format(src="el"))
ERIC_LTE_WIDE_BASE = _w(dt.KL_SQL, dt.SL_SQL, vt.ERIC_LTE_SQL, vt.ERIC_LTE_WIDE_SQL,
                        _ERIC_LTE_ENRICHED_SQL.format(src="ew"))
ERIC_UMTS_BASE = _w(dt.KL_SQL, dt.SL_SQL, vt.ERIC_UMTS_SQL, _ERIC_UMTS_ENRICHED_SQL)


def _eric_lte_counters(rop: bool) -> str:
    ho = "pmCellHoExeAttLteInterF" if rop else "pmHoExeAttLteInterF"      # the other one is not in the spec
    return ",\n  ".join([
        _sum0("PERIOD_DURATION"), _sum0("PERIOD_DURATION", "period_duration_eutcfd19"),
        _sum0("pmRrcConnEstabAtt"), _r("max(ifnull(pmRrcConnMax, 0))", "pmRrcConnMax"),
        _sum0("pmHoPrepAtt"), _sum0("pmHoPrepAtt", "pmHoPrepAtt_gcr"),
        _sum0("pmHoExeSucc"), _sum0("pmHoExeSucc", "pmHoExeSucc_gcr"),
        _sum0(ho, "pmHoExeAttLteInterF"),
        _sum0("pmRadioRecInterferencePwrPucch_0", "pmRadioRecInterfernPwrPucch_0"),
        _sum0("pmPdcchCceUtil_0"), _sum0("pmPdcchCceUtil_1"), _sum0("pmPdcchCceUtil_2"),
    ])


# The spec names its counters: the reporting-period spec the first handover
# name, the hourly spec the second; the input has both.
ROP_COUNTERS = [c for c in vt.ERIC_LTE_COUNTERS if c != "pmHoExeAttLteInterF"]
HOUR_COUNTERS = [c for c in vt.ERIC_LTE_COUNTERS if c != "pmCellHoExeAttLteInterF"]
UMTS_HOUR_COUNTERS = vt.ERIC_UMTS_COUNTERS[1:]
_ERIC_LABELS = "'unassigned' AS MGR_RUN_ID, min(Region) AS Region, min(Market) AS Market, " \
               "min(SubNetwork_2) AS SubNetwork_2"


@q("family_eric_lte_rop", ERIC_LTE_BASE + f"""SELECT {_ERIC_LABELS},
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, MeContext, EUtranCellFDD,
  {_eric_lte_counters(True)},
  {_ts('HL_DATE')} AS HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, EUtranCellFDD AS HL_Sector,
  '' AS HL_Sectorlayer, MeContext AS HL_Site, HL_Cluster, HL_Area, HL_Market, OSSName AS OSS,
  pk_date, HL_Market AS pk_market, pk_hr
FROM e GROUP BY HL_DATE, PERIOD_START_TIME, MeContext, EUtranCellFDD, HL_Market, HL_Cluster, HL_Area, OSSName,
  pk_date, pk_hr""")
def family_eric_lte_rop(spark, sf):
    """Ericsson LTE at reporting-period grain."""
    return finish(aggregate(_eric_lte(spark, sf), fam.ericsson_lte(counters=ROP_COUNTERS), grain="rop"))


@q("family_eric_lte_hourly", ERIC_LTE_BASE + f"""SELECT {_ERIC_LABELS},
  {_ts('HL_DATE')} AS PERIOD_START_TIME, MeContext, EUtranCellFDD,
  {_eric_lte_counters(False)},
  {_ts('HL_DATE')} AS HL_Date_Hour, {_ts('HL_DATE')} AS HL_Date, EUtranCellFDD AS HL_Sector,
  '' AS HL_Sectorlayer, MeContext AS HL_Site, HL_Cluster, HL_Area, HL_Market,
  pk_date, HL_Market AS pk_market, pk_hr
FROM e GROUP BY HL_DATE, MeContext, EUtranCellFDD, HL_Market, HL_Cluster, HL_Area, pk_date, pk_hr""")
def family_eric_lte_hourly(spark, sf):
    """Ericsson LTE hourly spec (no OSS key, un-prefixed handover names)."""
    return finish(aggregate(_eric_lte(spark, sf), fam.ericsson_lte(hourly=True, counters=HOUR_COUNTERS), grain="hour"))


@q("family_eric_lte_daily", ERIC_LTE_BASE + f"""SELECT {_ERIC_LABELS},
  {_day('HL_DATE')} AS PERIOD_START_TIME, MeContext, EUtranCellFDD,
  {_eric_lte_counters(True)},
  {_day('HL_DATE')} AS HL_Date_Hour, {_day('HL_DATE')} AS HL_Date, EUtranCellFDD AS HL_Sector,
  '' AS HL_Sectorlayer, MeContext AS HL_Site, HL_Cluster, HL_Area, HL_Market, OSSName AS OSS,
  pk_date, HL_Market AS pk_market
FROM e GROUP BY MeContext, EUtranCellFDD, HL_Market, HL_Cluster, HL_Area, OSSName, pk_date""")
def family_eric_lte_daily(spark, sf):
    """A9 with the E1 spec: a true daily collapse (the period key goes too)."""
    return finish(aggregate(_eric_lte(spark, sf), fam.ericsson_lte(counters=ROP_COUNTERS), grain="day"))


@q("family_eric_lte_wide", ERIC_LTE_WIDE_BASE + f"""SELECT {_ERIC_LABELS},
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, MeContext, EUtranCellFDD,
  {_eric_lte_counters(True)},
  """ + ",\n  ".join(_sum0(f"{vt.WIDE_PREFIX}{i}") for i in range(vt.WIDE_COUNTERS)) + f""",
  {_ts('HL_DATE')} AS HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, EUtranCellFDD AS HL_Sector,
  '' AS HL_Sectorlayer, MeContext AS HL_Site, HL_Cluster, HL_Area, HL_Market, OSSName AS OSS,
  pk_date, HL_Market AS pk_market, pk_hr
FROM e GROUP BY HL_DATE, PERIOD_START_TIME, MeContext, EUtranCellFDD, HL_Market, HL_Cluster, HL_Area, OSSName,
  pk_date, pk_hr""")
def family_eric_lte_wide(spark, sf):
    """E1 at a realistic width (~300 counters): histograms travel as arrays, labels
    are aggregated as codes, so one scan and one pass over runs of rows do."""
    compile_wide_plans(spark)
    rows = _eric_lte(spark, sf)
    wide = [f"{vt.WIDE_PREFIX}{i}" for i in range(vt.WIDE_COUNTERS)]
    return finish(aggregate(rows, fam.ericsson_lte(counters=[*ROP_COUNTERS, *wide]), grain="rop",
                            labels=label_texts(rows, ["Region", "Market", "SubNetwork_2"]),
                            widen=lambda r: pack_vectors(vt.eric_lte_wide(r)), by=["EUtranCellFDD", "HL_DATE"]))


_UMTS_SORT = "substr(UtranCell, 1, 1) || substr(UtranCell, -1, 1) || substr(UtranCell, -2, 1)"
_UMTS_LAYER = "CASE WHEN substring(UtranCell, 1, 1) = 'U' THEN 'AWS' ELSE 'PCS' END"
_ERIC_UMTS_LABELS = "'unassigned' AS MGR_RUN_ID, min(Region) AS region, min(Market) AS market, " \
                    "min(SubNetwork_2) AS subnetwork_2"


@q("family_eric_umts_rop", ERIC_UMTS_BASE + f"""SELECT {_ERIC_UMTS_LABELS},
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION')},
  min(MeContext) AS mecontext, UtranCell AS utrancell,
  {_sum0('pmNoRabEstablishAttemptSpeech', 'pmNoRabEstablishAttempSpeech')}, {_sum0('pmnorabestablishsuccessspeech')},
  {_sum0('pmnonormalrabreleasespeech')},
  {_UMTS_SORT} AS hl_umtssort, {_ts('HL_DATE')} AS HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date,
  UtranCell AS HL_Sector, {_UMTS_LAYER} AS HL_Sectorlayer, HL_Site, HL_Cluster, HL_Area, HL_Market,
  OSSName AS OSS, pk_date, HL_Market AS pk_market, pk_hr
FROM e GROUP BY HL_DATE, PERIOD_START_TIME, UtranCell, HL_Market, HL_Cluster, HL_Area, HL_Site, OSSName,
  pk_date, pk_hr""")
def family_eric_umts_rop(spark, sf):
    """Ericsson UMTS at reporting-period grain (sort key, sector layer, site from lookup)."""
    return finish(aggregate(_eric_umts(spark, sf), fam.ericsson_umts(counters=vt.ERIC_UMTS_COUNTERS), grain="rop"))


@q("family_eric_umts_hourly", ERIC_UMTS_BASE + f"""SELECT {_ERIC_UMTS_LABELS},
  {_ts('HL_DATE')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION')},
  min(MeContext) AS mecontext, UtranCell AS utrancell,
  {_sum0('pmnorabestablishsuccessspeech')}, {_sum0('pmnonormalrabreleasespeech')},
  {_UMTS_SORT} AS hl_umtssort, {_ts('HL_DATE')} AS HL_Date_Hour, {_ts('HL_DATE')} AS HL_Date,
  UtranCell AS HL_Sector, {_UMTS_LAYER} AS HL_Sectorlayer, 'U' || substring(UtranCell, 2, 8) AS HL_Site,
  'unassigned' AS HL_Cluster, 'unassigned' AS HL_Area, HL_Market,
  pk_date, HL_Market AS pk_market, pk_hr
FROM e GROUP BY HL_DATE, HL_Market, UtranCell, pk_date, pk_hr""")
def family_eric_umts_hourly(spark, sf):
    """Ericsson UMTS hourly (site by the name rule, cluster/area constant)."""
    return finish(aggregate(_eric_umts(spark, sf), fam.ericsson_umts(hourly=True, counters=UMTS_HOUR_COUNTERS), grain="hour"))


# --------------------------------------------------------------------- Nokia

def _nokia(rows: DataFrame, lookup: DataFrame, tech: str, family: str) -> DataFrame:
    e = derive_hl_date(enrich_for(rows, lookup, "nokia", tech))
    e = derive_pk(e, date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME")
    return e.withColumn("pk_ft", F.lit(family))


def _nokia_enriched_sql(src: str, lookup: str, cell_col: str, family: str) -> str:
    return f"""ne AS (
  SELECT k.*, IFNULL(l.CELL, 'unassigned') AS HL_Sector, IFNULL(l.SITE, 'unassigned') AS HL_Site,
         IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
         IFNULL(l.AREA, 'unassigned') AS HL_Area,
         strftime(k.PERIOD_START_TIME, '%Y-%m-%d %H:00:00') AS HL_Date_Hour, '{family}' AS pk_ft,
         strftime(k.PERIOD_START_TIME, '%Y-%m-%d') AS pk_date, strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM {src} k LEFT JOIN {lookup} l ON upper(k.OSS) = upper(l.OSS) AND k.{cell_col} = l.CELL_UID)"""


_NOKIA_TAIL = """HL_Sector, '' AS HL_Sectorlayer, HL_Site, HL_Cluster, HL_Area, HL_Market,
  pk_ft, pk_date, HL_Market AS pk_market"""
_NOKIA_LTE_KEYS = "HL_Sector, HL_Site, HL_Cluster, HL_Area, HL_Market, pk_ft, pk_date"


def _cell_load_measures() -> str:
    return ",\n  ".join([
        _sum("rach_stp_att_small_msg"),
        _r("max(try_cast(rrc_conn_ue_max AS DOUBLE))", "rrc_conn_ue_max"),
        _r("avg(try_cast(rrc_conn_ue_avg AS DOUBLE))", "rrc_conn_ue_avg"),
        _r("max(try_cast(cell_load_act_ue_max AS DOUBLE))", "cell_load_act_ue_max"),
        _r("avg(try_cast(cell_load_act_ue_avg AS DOUBLE))", "cell_load_act_ue_avg"),
        _r("avg(pdcp_sdu_delay_dl_dtch_mean)", "pdcp_sdu_delay_dl_dtch_mean"),
    ])


CELL_LOAD_BASE = _w(dt.KC_SQL, dt.CL_SQL, vt.NOKIA_CELL_LOAD_SQL,
                    _nokia_enriched_sql("nl", "cl", "MO_DN2", "lte_cell_load"))


@q("family_nokia_lte_cell_load", CELL_LOAD_BASE + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(OSS) AS oss,
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  MO_DN AS mo_dn, MO_DN2 AS cell,
  {_cell_load_measures()},
  HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY PERIOD_START_TIME, HL_Date_Hour, MO_DN, MO_DN2, {_NOKIA_LTE_KEYS}, pk_hr""")
def family_nokia_lte_cell_load(spark, sf):
    """Text-typed counters under MAX/AVG are cast first (numeric, not text order)."""
    rows = _nokia(vt.nokia_cell_load_rows(spark, sf), dt.cl(spark, sf), "lte", "lte_cell_load")
    return finish(aggregate(rows, fam.nokia_lte("cell_load"), grain="rop"))


@q("family_nokia_lte_cell_load_daily", CELL_LOAD_BASE + f"""SELECT 'unassigned' AS MGR_RUN_ID,
  min(OSS) AS oss, {_day('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  MO_DN AS mo_dn, MO_DN2 AS cell,
  {_cell_load_measures()},
  {_day('PERIOD_START_TIME')} AS HL_Date_Hour, {_day('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}
FROM ne GROUP BY MO_DN, MO_DN2, {_NOKIA_LTE_KEYS}""")
def family_nokia_lte_cell_load_daily(spark, sf):
    """Nokia daily roll-up with the current (ROP) spec: a true daily collapse."""
    rows = _nokia(vt.nokia_cell_load_rows(spark, sf), dt.cl(spark, sf), "lte", "lte_cell_load")
    return finish(aggregate(rows, fam.nokia_lte("cell_load"), grain="day"))


_HOUR = "date_trunc('hour', PERIOD_START_TIME)"


@q("family_nokia_lte_cell_load_hourly", CELL_LOAD_BASE + f"""SELECT 'unassigned' AS MGR_RUN_ID,
  min(OSS) AS oss, {_ts(_HOUR)} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  MO_DN AS mo_dn, MO_DN2 AS cell,
  {_cell_load_measures()},
  {_ts(_HOUR)} AS HL_Date_Hour, {_ts(_HOUR)} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY {_HOUR}, MO_DN, MO_DN2, {_NOKIA_LTE_KEYS}, pk_hr""")
def family_nokia_lte_cell_load_hourly(spark, sf):
    """N9 with the hl_date-grain spec set: every time column is the hour of
    hl_date (the period start in the Nokia layout, truncated), so the
    quarter-hours of an hour are one row; no HL_Date_Hour / period keys."""
    rows = _nokia(vt.nokia_cell_load_rows(spark, sf), dt.cl(spark, sf), "lte", "lte_cell_load")
    return finish(aggregate(rows, fam.nokia_lte("cell_load"), grain="hour"))


@q("family_nokia_lte_throughput", _w(dt.KL_SQL, dt.SL_SQL, vt.NOKIA_THROUGHPUT_SQL,
                                      _nokia_enriched_sql("nl", "sl", "MO_DN2", "lte_cell_throughput"))
   + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(OSS) AS oss,
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  MO_DN AS mo_dn, MO_DN2 AS cell,
  CAST(sum(pdcp_sdu_vol_ul) AS BIGINT) AS pdcp_sdu_vol_ul,
  {_r('max(pdcp_data_rate_max_ul)', 'pdcp_data_rate_max_ul')},
  {_r('max(pdcp_data_rate_max_dl)', 'pdcp_data_rate_max_dl')}, {_sum('IP_TPUT_TIME_UL_QCI_6')},
  HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY PERIOD_START_TIME, HL_Date_Hour, MO_DN, MO_DN2, {_NOKIA_LTE_KEYS}, pk_hr""")
def family_nokia_lte_throughput(spark, sf):
    """A long counter (stays integral) and two maxima."""
    rows = _nokia(vt.nokia_throughput_rows(spark, sf), dt.sl(spark, sf), "lte", "lte_cell_throughput")
    return finish(aggregate(rows, fam.nokia_lte("cell_throughput"), grain="rop"))


@q("family_nokia_lte_gsm_nb", _w(dt.KC_SQL, dt.CL_SQL, vt.NOKIA_GSM_NB_SQL,
                                  _nokia_enriched_sql("nl", "cl", "MO_DN2", "lte_isys_ho_gsm_nb_sum"))
   + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(OSS) AS oss,
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  MO_DN_Source AS mo_dn, MO_DN2 AS cell, {_sum('ISYS_HO_GERAN_SRVCC_ATT_NB')}, {_sum('ISYS_HO_GERAN_SRVCC_FAIL_NB')},
  HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY PERIOD_START_TIME, HL_Date_Hour, MO_DN_Source, MO_DN2, {_NOKIA_LTE_KEYS}, pk_hr""")
def family_nokia_lte_gsm_nb(spark, sf):
    """Neighbour family keyed by MO_DN_Source."""
    rows = _nokia(vt.nokia_gsm_nb_rows(spark, sf), dt.cl(spark, sf), "lte", "lte_isys_ho_gsm_nb_sum")
    return finish(aggregate(rows, fam.nokia_lte("isys_ho_gsm_nb_sum"), grain="rop"))


@q("family_nokia_umts_soft_ho", _w(dt.KC_SQL, dt.CL_SQL, vt.NOKIA_SOFT_HO_SQL,
                                   _nokia_enriched_sql("nu", "cl", "CELL_ID_1", "umts_soft_handover"))
   + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(OSS) AS oss,
  {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME, {_sum('PERIOD_DURATION', 'period_duration')},
  BASEID, LOCALMOID, CELL_ID_1, CELL_ID_2,
  {_sum('cpich_ecno_class_0')}, {_sum('cpich_ecno_class_1')}, {_r('sum(try_cast(cell_add_req_on_sho_for_rt AS DOUBLE))', 'cell_add_req_on_sho_for_rt')},
  HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY PERIOD_START_TIME, HL_Date_Hour, BASEID, LOCALMOID, CELL_ID_1, CELL_ID_2,
  {_NOKIA_LTE_KEYS}, pk_hr""")
def family_nokia_umts_soft_ho(spark, sf):
    """M11 (derived rule): UMTS identity keys, SUM of every counter incl. a text one."""
    rows = _nokia(vt.nokia_soft_ho_rows(spark, sf), dt.cl(spark, sf), "umts", "umts_soft_handover")
    return finish(aggregate(rows, fam.nokia_umts("soft_handover"), grain="rop"))


# ------------------------------------------- the other Nokia families, by rule

# How many counters each family's registered schema has.
SCHEMA_COUNTERS = {
    "lte": {"cell_avail": 4, "cell_resource": 21, "eps_bearer": 100, "handover": 5, "inter_enb_ho": 9, "inter_sys_ho": 15,
            "intra_enb_ho": 6, "isys_ho_utran_nb_sum": 4, "pwr_and_qual_dl": 17, "pwr_and_qual_ul": 71, "rrc": 7,
            "ue_state": 20, "ue_quantity": 4},
    "umts": {"cell_resource": 106, "cell_throughput_wbts": 5, "hsdpa_wbts": 97, "inter_system_handover": 56,
             "intra_system_handover": 33, "packet_call": 45, "rcpm_olpc_wcel_sum": 12, "rcpm_rlc_wcel_sum": 8, "rrc": 30,
             "service_level": 109, "traffic": 46},
}
# How many of a family's counters are registered as text.
TEXT_COUNTERS = {("lte", "eps_bearer"): 21, ("lte", "ue_state"): 2}


def schema_fields(tech: str, family: str) -> list[dict]:
    """A family's schema file: the vendor's identity columns, the counters that its
    spec names (other functions, renames), and as many more as the family has."""
    named = [c for c, _ in fam.NOKIA_LTE_OVERRIDES.get(family, ()) + fam.NOKIA_LTE_RENAMES.get(family, ())] if tech == "lte" else []
    more = [f"{family}_{i:03d}_cnt" for i in range(len(named), SCHEMA_COUNTERS[tech][family])]
    texts = TEXT_COUNTERS.get((tech, family), 0)
    mo = "MO_DN_Source" if family in fam.NOKIA_SOURCE_KEYED else "MO_DN"
    ids = ["BASEID", "LOCALMOID", "CELL_ID_1", "CELL_ID_2"] if tech == "umts" else [mo, "MO_DN2"]
    columns = [(c, "string") for c in ("MGR_RUN_ID", "Region", "Market", "OSS")] + [("PERIOD_START_TIME", "timestamp"), ("PERIOD_DURATION", "double")]
    columns += [(c, "string") for c in ids]
    columns += [(c, "string" if i < texts else "long" if i % 9 == 8 else "double") for i, c in enumerate(more + named)]
    return [{"metadata": {}, "type": t, "name": c, "nullable": True} for c, t in columns]


def counter_types(schema: T.StructType, tech: str) -> dict[str, str]:
    known = {c.lower() for c in IDENTITY["nokia", tech]} | {"period_duration"}
    return {f.name: f.dataType.simpleString() for f in schema.fields if f.name.lower() not in known}


def counter_value(i: int, kind: str) -> str:
    """Value of a family's ``i``-th counter on a record of ``kc``; both engines read it."""
    if kind == "string":
        return "v_str"
    if kind == "bigint":
        return f"CAST(event_id % {50 + i} AS BIGINT)"
    return (f"value * {i % 7 + 1}", "v_null", f"CAST(floor(value) AS DOUBLE) + {i}", f"CASE WHEN event_id % {i + 2} = 0 THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) END")[i % 4]


_REGISTRIES: dict = {}


def registry(spark) -> SchemaRegistry:
    """Schema files of all these families, written to and loaded from a folder."""
    key = spark.sparkContext.applicationId
    if key not in _REGISTRIES:
        folder = scratch_path(spark, "schemas")
        for tech, families in SCHEMA_COUNTERS.items():
            for family in families:
                write_text_file(spark, f"{folder}/{tech}_nokia_{family}_schema.json", json.dumps(schema_fields(tech, family)))
        _REGISTRIES[key] = SchemaRegistry.from_path(spark, folder)
    return _REGISTRIES[key]


def _family_rows(spark, sf, tech: str, family: str) -> DataFrame:
    """Rows of a family with every counter of its registered schema."""
    source_keyed = family in fam.NOKIA_SOURCE_KEYED
    counters = counter_types(registry(spark)[f"{tech}_{family}"], tech)
    ids = vt.nokia_ids(dt.kc(spark, sf), tech, source_keyed)
    return dt.kc(spark, sf).select(*ids, *[F.expr(f"{counter_value(i, t)} AS `{c}`") for i, (c, t) in enumerate(counters.items())])


def _register_other(tech: str, family: str) -> None:
    source_keyed = family in fam.NOKIA_SOURCE_KEYED
    mo = "MO_DN_Source" if source_keyed else "MO_DN"
    ids = f"{mo} AS mo_dn, MO_DN2 AS cell" if tech == "lte" else "BASEID, LOCALMOID, CELL_ID_1, CELL_ID_2"
    keys = f"{mo}, MO_DN2" if tech == "lte" else "BASEID, LOCALMOID, CELL_ID_1, CELL_ID_2"
    cell = "MO_DN2" if tech == "lte" else "CELL_ID_1"
    kinds = {"double": "double", "long": "bigint", "string": "string"}
    fields = [(f["name"], kinds[f["type"]]) for f in schema_fields(tech, family)[6 + (4 if tech == "umts" else 2):]]
    func = dict(fam.NOKIA_LTE_OVERRIDES.get(family, ())) if tech == "lte" else {}
    alias = dict(fam.NOKIA_LTE_RENAMES.get(family, ())) if tech == "lte" else {}

    def measure(c: str, t: str) -> str:
        if t == "bigint" and func.get(c, "sum") == "sum":
            return f"CAST(sum({c}) AS BIGINT) AS {alias.get(c, c)}"
        return _r(f"{func.get(c, 'sum')}({f'try_cast({c} AS DOUBLE)' if t == 'string' else c})", alias.get(c, c))

    values = [f"{counter_value(i, t)} AS {c}" for i, (c, t) in enumerate(fields)]

    @q(f"family_nokia_{tech}_{family}", _w(dt.KC_SQL, dt.CL_SQL, vt.nokia_rows_sql(tech, values, source_keyed),
                                           _nokia_enriched_sql("nr", "cl", cell, f"{tech}_{family}"))
       + f"""SELECT 'unassigned' AS MGR_RUN_ID, min(OSS) AS oss, {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME,
  {_sum('PERIOD_DURATION', 'period_duration')}, {ids}, {', '.join(measure(*f) for f in fields)},
  HL_Date_Hour, {_ts('PERIOD_START_TIME')} AS HL_Date, {_NOKIA_TAIL}, pk_hr
FROM ne GROUP BY PERIOD_START_TIME, HL_Date_Hour, {keys}, {_NOKIA_LTE_KEYS}, pk_hr""")
    def family_query(spark, sf):
        rows = _nokia(_family_rows(spark, sf, tech, family), dt.cl(spark, sf), tech, f"{tech}_{family}")
        spec = fam.nokia_lte(family) if tech == "lte" else fam.nokia_umts(family)
        return finish(aggregate(rows, spec, grain="rop"))


for _tech, _families in SCHEMA_COUNTERS.items():
    for _family in _families:
        _register_other(_tech, _family)


# --------------------------------- the older Ericsson text specs (plain sums)

def older_lte_features() -> str:
    """A feature file of the older LTE form: 183 plain sums, three maxima, three labels,
    two constants in a counter's place, hourly keys."""
    sums = [c for c in HOUR_COUNTERS if c != "pmRrcConnMax"]
    sums = ["PERIOD_DURATION", *sums] + [f"{vt.WIDE_PREFIX}{i}" for i in range(183 - 1 - len(sums))]
    select = ["'unassigned' as MGR_RUN_ID", "MIN(Region) as Region", "MIN(Market) as Market", "MIN(SubNetwork_2) as SubNetwork_2",
              "hl_date as PERIOD_START_TIME", "MeContext", "EUtranCellFDD", *[f"SUM({c}) as {c}" for c in sums],
              "MAX(pmRrcConnMax) as pmRrcConnMax", f"MAX({vt.WIDE_PREFIX}298) as {vt.WIDE_PREFIX}298", f"MAX({vt.WIDE_PREFIX}299) as {vt.WIDE_PREFIX}299",
              "0 as pmPlaceholder_0", "0 as pmPlaceholder_1", "HL_Cluster", "HL_Area", "HL_Market"]
    return _feature("lte_eric_older", select, "hl_date, MeContext, EUtranCellFDD, HL_Market, HL_Cluster, HL_Area")


def older_umts_features() -> str:
    """The older UMTS form: 48 plain sums, four labels, 18 constants, hourly keys."""
    sums = ["PERIOD_DURATION", *vt.ERIC_UMTS_COUNTERS] + [f"{vt.WIDE_PREFIX}{i}" for i in range(48 - 1 - len(vt.ERIC_UMTS_COUNTERS))]
    select = ["'unassigned' as MGR_RUN_ID", "MIN(Region) as region", "MIN(Market) as market", "MIN(SubNetwork_2) as subnetwork_2",
              "hl_date as PERIOD_START_TIME", "MIN(MeContext) as mecontext", "UtranCell", *[f"SUM({c}) as {c}" for c in sums],
              *[f"0 as pmPlaceholder_{i}" for i in range(18)], "HL_Market"]
    return _feature("umts_eric_older", select, "hl_date, HL_Market, UtranCell")


def _feature(name: str, select: list[str], groupby: str) -> str:
    return json.dumps({"features": [{"name": name, "sql": [{"SELECT": ", ".join(select), "GROUPBY": groupby}]}]})


def _older_sql(feature: str) -> str:
    """The text spec as DuckDB SQL: its own text, rendered like a report."""
    (select, groupby), = parse_sql_features(feature).values()
    out = []
    for item in select.split(", "):
        expr, _, alias = item.partition(" as ")
        alias = alias or expr
        numeric = expr.startswith(("SUM(", "MAX("))
        out.append(_r(expr, alias) if numeric else f"{_ts('HL_DATE')} AS {alias}" if expr == "hl_date" else f"CAST(0 AS INTEGER) AS {alias}" if expr == "0" else f"{expr} AS {alias}")
    return f"SELECT {', '.join(out)}, pk_date, HL_Market AS pk_market, pk_hr FROM e GROUP BY {groupby}, pk_date, pk_hr"


def _older(spark, rows: DataFrame, widen: Callable[[DataFrame], DataFrame], cell: str, feature: str, name: str) -> DataFrame:
    """Write the feature file, load it, run its text over ``rows`` in the wide layout. They are dealt
    without their partition keys, put in the order of all keys before they are wide, and added up as runs."""
    compile_wide_plans(spark)
    path = write_text_file(spark, f"{scratch_path(spark, 'features')}/{name}.json", feature)
    text = spark.read.text(path, wholetext=True).first().value
    select, groupby = parse_sql_features(text)[name]
    extra = ("pk_date", "pk_market", "pk_hr")
    store = widen(deal_groups(rows, [cell, "HL_DATE"], order=[*(k.strip() for k in groupby.split(",")), *extra], derive=_eric_pk))
    return finish(sql_feature_aggregate(store, select, groupby, extra_keys=extra, dealt=True))


@q("family_eric_lte_older", ERIC_LTE_WIDE_BASE + _older_sql(older_lte_features()))
def family_eric_lte_older(spark, sf):
    """E5: the older LTE text spec, 183 sums that keep NULL."""
    return _older(spark, _eric_lte_unkeyed(spark, sf), vt.eric_lte_wide, "EUtranCellFDD", older_lte_features(), "lte_eric_older")


@q("family_eric_umts_older", _w(dt.KL_SQL, dt.SL_SQL, vt.ERIC_UMTS_SQL, vt.ERIC_UMTS_WIDE_SQL,
                                _ERIC_UMTS_ENRICHED_SQL.replace("FROM eu k", "FROM euw k")) + _older_sql(older_umts_features()))
def family_eric_umts_older(spark, sf):
    """E5: the older UMTS text spec, 48 sums and 18 constants."""
    return _older(spark, _eric_umts_unkeyed(spark, sf), vt.eric_umts_wide, "UtranCell", older_umts_features(), "umts_eric_older")

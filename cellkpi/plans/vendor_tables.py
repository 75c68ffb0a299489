"""The driver tables in the four vendor input layouts.

The family specs (``plans.families``) expand over the columns of a vendor's
counter file, so they can only be exercised on rows shaped like those
files. These builders give such rows, derived from the whole driver tables
(``kl`` from ``lineitem``, ``kc`` from ``events``, see ``driver_tables``):

* Ericsson LTE / UMTS   from ``kl`` (cell = supplier), lookup from ``supplier``
* Nokia LTE / UMTS      from ``kc`` (cell = user) and ``kl``, lookups from
  ``customer`` / ``supplier`` (CELL_UID)

Each exists as a DataFrame builder and as a DuckDB CTE over the same parquet
files, so the catalogue can compare the spec compiler with hand-written SQL.
NULL counters, text counters with junk, mixed-case and unknown OSS names and
NULL OSS names occur by rule, so the null policies, tolerant casts and the
'unassigned' default are all visible in the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.plans import driver_tables as dt

# Counter and identity column names as the vendors' files carry them.
ERIC_LTE_COUNTERS = ("pmRrcConnEstabAtt", "pmRrcConnMax", "pmHoPrepAtt", "pmHoExeSucc",
                     "pmCellHoExeAttLteInterF", "pmHoExeAttLteInterF", "pmRadioRecInterferencePwrPucch_0",
                     "pmPdcchCceUtil_0", "pmPdcchCceUtil_1", "pmPdcchCceUtil_2")
ERIC_UMTS_COUNTERS = ("pmNoRabEstablishAttemptSpeech", "pmnorabestablishsuccessspeech", "pmnonormalrabreleasespeech")
NOKIA_CELL_LOAD_COUNTERS = ("rach_stp_att_small_msg", "rrc_conn_ue_max", "rrc_conn_ue_avg",
                            "cell_load_act_ue_max", "cell_load_act_ue_avg", "pdcp_sdu_delay_dl_dtch_mean")
NOKIA_THROUGHPUT_COUNTERS = ("pdcp_sdu_vol_ul", "pdcp_data_rate_max_ul", "pdcp_data_rate_max_dl", "IP_TPUT_TIME_UL_QCI_6")
NOKIA_GSM_NB_COUNTERS = ("ISYS_HO_GERAN_SRVCC_ATT_NB", "ISYS_HO_GERAN_SRVCC_FAIL_NB")
NOKIA_SOFT_HO_COUNTERS = ("cpich_ecno_class_0", "cpich_ecno_class_1", "cell_add_req_on_sho_for_rt")

MO_DN_PREFIX = "MRBTS-"
DURATION = 900.0
UNKNOWN_OSS = "OSS9"


def _lbl(prefix: str, x: Column) -> Column:
    return F.concat(F.lit(prefix), x.cast("string"))


def _null_when(cond: Column, v: Column) -> Column:
    return F.when(cond, F.lit(None).cast("double")).otherwise(v)


# ------------------------------------------------------------------ Ericsson

def _eric_oss(sk: Column, ok: Column) -> Column:
    """OSS name: NULL, unknown, lower- or upper-case (the join is case-insensitive)."""
    num = (sk % 4).cast("string")
    return (F.when(ok % 13 == 0, F.lit(None).cast("string"))
             .when(ok % 11 == 0, F.lit(UNKNOWN_OSS))
             .when(ok % 2 == 1, F.concat(F.lit("oss"), num))
             .otherwise(F.concat(F.lit("OSS"), num)))


def _eric_common(k: DataFrame) -> list[Column]:
    sk, ok = F.col("cell").cast("bigint"), F.col("l_orderkey")
    return [F.col("HL_DATE"), F.lit("stale").alias("HL_MARKET"),
            _lbl("R", sk % 3).alias("Region"), _lbl("M", sk % 5).alias("Market"),
            _lbl("SN", ok % 7).alias("SubNetwork_2"), _lbl("ME", F.floor(sk / 4)).alias("MeContext")]


def eric_lte_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = dt.kl(spark, sf)
    sk, ok, flag = F.col("cell").cast("bigint"), F.col("l_orderkey"), F.col("l_returnflag")
    counters = [
        F.col("l_quantity"),
        _null_when(flag == "R", F.col("l_discount") * 100),
        F.col("l_linenumber").cast("double"),
        _null_when(flag == "A", F.col("l_tax") * 100),
        F.col("l_quantity") * F.col("l_discount"),
        F.col("l_quantity") * F.col("l_tax"),
        F.col("l_extendedprice") / 100,
        F.col("qbin_0").cast("double"), F.col("qbin_1").cast("double"),
        _null_when(flag == "N", F.col("qbin_2").cast("double")),
    ]
    return k.select(*_eric_common(k), F.col("cell").alias("EUtranCellFDD"), "PERIOD_START_TIME",
                    _null_when(F.col("l_linenumber") == 7, F.lit(DURATION)).alias("PERIOD_DURATION"),
                    _eric_oss(sk, ok).alias("OSSName"),
                    *[c.alias(n) for c, n in zip(counters, ERIC_LTE_COUNTERS)])


# A realistic width: vendor ROP specs aggregate ~300 counters. The wide
# layout adds WIDE_COUNTERS histogram-style bins (generated by a rule from the
# bulk counters, integral values, every fifth bin NULL on returned lines).
WIDE_PREFIX = "pmWideDistr_"
WIDE_COUNTERS = 300


def _wide_bin(i: int, qty: Column, line: Column, null_if: Column) -> Column:
    v = qty * (i % 7 + 1) + line
    return _null_when(null_if, v) if i % 5 == 0 else v


def eric_lte_wide(r: DataFrame, n: int = WIDE_COUNTERS) -> DataFrame:
    """Rows of :func:`eric_lte_rows` (enriched or not) with the wide layout's bins."""
    qty, line, returned = F.col("pmRrcConnEstabAtt"), F.col("pmHoPrepAtt"), F.col("pmRrcConnMax").isNull()
    return r.select("*", *[_wide_bin(i, qty, line, returned).alias(f"{WIDE_PREFIX}{i}") for i in range(n)])


def eric_lte_wide_rows(spark: SparkSession, sf: str, n: int = WIDE_COUNTERS) -> DataFrame:
    return eric_lte_wide(eric_lte_rows(spark, sf), n)


def umts_cell(sk: Column) -> Column:
    """UMTS cell name: 'U…' (AWS layer) for every third cell, 'P…' otherwise."""
    return F.concat(F.when(sk % 3 == 0, F.lit("U")).otherwise(F.lit("P")), (F.lit(1000000) + sk * 7).cast("string"))


def eric_umts_rows(spark: SparkSession, sf: str) -> DataFrame:
    k = dt.kl(spark, sf)
    sk, ok, flag = F.col("cell").cast("bigint"), F.col("l_orderkey"), F.col("l_returnflag")
    return k.select(*_eric_common(k), umts_cell(sk).alias("UtranCell"), "PERIOD_START_TIME",
                    _null_when(F.col("l_linenumber") == 7, F.lit(DURATION)).alias("PERIOD_DURATION"),
                    _eric_oss(sk, ok).alias("OSSName"),
                    _null_when(flag == "R", F.col("l_quantity")).alias(ERIC_UMTS_COUNTERS[0]),
                    (F.col("l_extendedprice") / 100).alias(ERIC_UMTS_COUNTERS[1]),
                    (F.col("l_tax") * 100).alias(ERIC_UMTS_COUNTERS[2]), F.col("l_linenumber").cast("double").alias("Cntr"))


def umts_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier lookup with UMTS cell names."""
    s = dt.sl(spark, sf)
    return s.withColumn("CELL", umts_cell(F.col("CELL_UID").cast("bigint")))


_ERIC_COMMON_SQL = """HL_DATE, 'stale' AS HL_MARKET,
         'R' || CAST(CAST(cell AS BIGINT) % 3 AS VARCHAR) AS Region,
         'M' || CAST(CAST(cell AS BIGINT) % 5 AS VARCHAR) AS Market,
         'SN' || CAST(l_orderkey % 7 AS VARCHAR) AS SubNetwork_2,
         'ME' || CAST(CAST(cell AS BIGINT) // 4 AS VARCHAR) AS MeContext"""

_ERIC_OSS_SQL = f"""CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN '{UNKNOWN_OSS}'
              WHEN l_orderkey % 2 = 1 THEN 'oss' || CAST(CAST(cell AS BIGINT) % 4 AS VARCHAR)
              ELSE 'OSS' || CAST(CAST(cell AS BIGINT) % 4 AS VARCHAR) END AS OSSName"""

_UMTS_CELL_SQL = ("CASE WHEN {k} % 3 = 0 THEN 'U' ELSE 'P' END || CAST(1000000 + {k} * 7 AS VARCHAR)")

ERIC_LTE_SQL = f"""el AS (
  SELECT {_ERIC_COMMON_SQL},
         cell AS EUtranCellFDD, PERIOD_START_TIME,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE {DURATION} END AS PERIOD_DURATION,
         {_ERIC_OSS_SQL},
         l_quantity AS pmRrcConnEstabAtt,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount * 100 END AS pmRrcConnMax,
         CAST(l_linenumber AS DOUBLE) AS pmHoPrepAtt,
         CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_tax * 100 END AS pmHoExeSucc,
         l_quantity * l_discount AS pmCellHoExeAttLteInterF, l_quantity * l_tax AS pmHoExeAttLteInterF,
         l_extendedprice / 100 AS pmRadioRecInterferencePwrPucch_0,
         CAST(qbin_0 AS DOUBLE) AS pmPdcchCceUtil_0, CAST(qbin_1 AS DOUBLE) AS pmPdcchCceUtil_1,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(qbin_2 AS DOUBLE) END AS pmPdcchCceUtil_2
  FROM kl)"""

ERIC_UMTS_SQL = f"""eu AS (
  SELECT {_ERIC_COMMON_SQL},
         {_UMTS_CELL_SQL.format(k="CAST(cell AS BIGINT)")} AS UtranCell, PERIOD_START_TIME,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE {DURATION} END AS PERIOD_DURATION,
         {_ERIC_OSS_SQL},
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS pmNoRabEstablishAttemptSpeech,
         l_extendedprice / 100 AS pmnorabestablishsuccessspeech, l_tax * 100 AS pmnonormalrabreleasespeech,
         CAST(l_linenumber AS DOUBLE) AS Cntr
  FROM kl),
ul AS (SELECT * REPLACE ({_UMTS_CELL_SQL.format(k="CAST(CELL_UID AS BIGINT)")} AS CELL) FROM sl)"""


# --------------------------------------------------------------------- Nokia

def _nokia_common(u: Column) -> list[Column]:
    return [F.lit("unassigned").alias("MGR_RUN_ID"), _lbl("R", u % 3).alias("Region"),
            _lbl("M", u % 5).alias("Market")]


def _event_duration() -> Column:
    return _null_when(F.col("pk_ft") == "error", F.lit(DURATION)).alias("PERIOD_DURATION")


def nokia_cell_load_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Nokia LTE cell load: four text-typed counters (max / avg inputs)."""
    k = dt.kc(spark, sf)
    u = F.col("cell").cast("bigint")
    counters = [F.col("value"), F.col("v_str"), F.col("v_str"), (F.col("event_id") % 13).cast("string"),
                (u % 7).cast("string"), F.floor("value").cast("double")]
    return k.select(*_nokia_common(u), F.col("oss").alias("OSS"), "PERIOD_START_TIME", _event_duration(),
                    _lbl(MO_DN_PREFIX, u % 50).alias("MO_DN"), F.col("cell").alias("MO_DN2"),
                    *[c.alias(n) for c, n in zip(counters, NOKIA_CELL_LOAD_COUNTERS)])


def nokia_gsm_nb_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Nokia LTE GSM neighbour sums: keyed by MO_DN_Source instead of MO_DN."""
    k = dt.kc(spark, sf)
    u = F.col("cell").cast("bigint")
    return k.select(*_nokia_common(u), F.col("oss").alias("OSS"), "PERIOD_START_TIME", _event_duration(),
                    _lbl("SRC-", F.col("event_id") % 3).alias("MO_DN_Source"), F.col("cell").alias("MO_DN2"),
                    F.col("value").alias(NOKIA_GSM_NB_COUNTERS[0]), F.col("v_null").alias(NOKIA_GSM_NB_COUNTERS[1]))


def nokia_soft_ho_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Nokia UMTS soft handover: UMTS identity columns, one text counter."""
    k = dt.kc(spark, sf)
    u = F.col("cell").cast("bigint")
    return k.select(*_nokia_common(u), F.col("oss").alias("OSS"), "PERIOD_START_TIME", _event_duration(),
                    _lbl("RNC-", u % 7).alias("BASEID"), _lbl("WCEL-", u % 11).alias("LOCALMOID"),
                    F.col("cell").alias("CELL_ID_1"), _lbl("C", u % 2).alias("CELL_ID_2"),
                    *[c.alias(n) for c, n in zip((F.col("value"), F.col("v_null"), F.col("v_str")),
                                                 NOKIA_SOFT_HO_COUNTERS)])


def nokia_throughput_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Nokia LTE cell throughput from the bulk counters: a long counter and two maxima."""
    k = dt.kl(spark, sf)
    sk, flag = F.col("cell").cast("bigint"), F.col("l_returnflag")
    oss = F.when(F.col("l_orderkey") % 2 == 1, F.lower("oss")).otherwise(F.col("oss"))
    counters = [F.col("l_quantity").cast("bigint"), F.col("l_extendedprice") / 100,
                _null_when(flag == "R", F.col("l_discount") * 100), F.col("l_tax") * 100]
    return k.select(*_nokia_common(sk), oss.alias("OSS"), "PERIOD_START_TIME",
                    _null_when(F.col("l_linenumber") == 7, F.lit(DURATION)).alias("PERIOD_DURATION"),
                    _lbl(MO_DN_PREFIX, F.floor(sk / 4)).alias("MO_DN"), F.col("cell").alias("MO_DN2"),
                    *[c.alias(n) for c, n in zip(counters, NOKIA_THROUGHPUT_COUNTERS)])


def _nokia_common_sql(u: str) -> str:
    return (f"'unassigned' AS MGR_RUN_ID, 'R' || CAST({u} % 3 AS VARCHAR) AS Region, "
            f"'M' || CAST({u} % 5 AS VARCHAR) AS Market")


_EVENT_DURATION_SQL = f"CASE WHEN pk_ft = 'error' THEN NULL ELSE {DURATION} END AS PERIOD_DURATION"

NOKIA_CELL_LOAD_SQL = f"""nl AS (
  SELECT {_nokia_common_sql('CAST(cell AS BIGINT)')}, oss AS OSS, PERIOD_START_TIME, {_EVENT_DURATION_SQL},
         '{MO_DN_PREFIX}' || CAST(CAST(cell AS BIGINT) % 50 AS VARCHAR) AS MO_DN, cell AS MO_DN2,
         value AS rach_stp_att_small_msg, v_str AS rrc_conn_ue_max, v_str AS rrc_conn_ue_avg,
         CAST(event_id % 13 AS VARCHAR) AS cell_load_act_ue_max,
         CAST(CAST(cell AS BIGINT) % 7 AS VARCHAR) AS cell_load_act_ue_avg,
         CAST(floor(value) AS DOUBLE) AS pdcp_sdu_delay_dl_dtch_mean
  FROM kc)"""

NOKIA_GSM_NB_SQL = f"""nl AS (
  SELECT {_nokia_common_sql('CAST(cell AS BIGINT)')}, oss AS OSS, PERIOD_START_TIME, {_EVENT_DURATION_SQL},
         'SRC-' || CAST(event_id % 3 AS VARCHAR) AS MO_DN_Source, cell AS MO_DN2,
         value AS ISYS_HO_GERAN_SRVCC_ATT_NB, v_null AS ISYS_HO_GERAN_SRVCC_FAIL_NB
  FROM kc)"""

NOKIA_SOFT_HO_SQL = f"""nu AS (
  SELECT {_nokia_common_sql('CAST(cell AS BIGINT)')}, oss AS OSS, PERIOD_START_TIME, {_EVENT_DURATION_SQL},
         'RNC-' || CAST(CAST(cell AS BIGINT) % 7 AS VARCHAR) AS BASEID,
         'WCEL-' || CAST(CAST(cell AS BIGINT) % 11 AS VARCHAR) AS LOCALMOID,
         cell AS CELL_ID_1, 'C' || CAST(CAST(cell AS BIGINT) % 2 AS VARCHAR) AS CELL_ID_2,
         value AS cpich_ecno_class_0, v_null AS cpich_ecno_class_1, v_str AS cell_add_req_on_sho_for_rt
  FROM kc)"""

NOKIA_THROUGHPUT_SQL = f"""nl AS (
  SELECT {_nokia_common_sql('CAST(cell AS BIGINT)')},
         CASE WHEN l_orderkey % 2 = 1 THEN lower(oss) ELSE oss END AS OSS, PERIOD_START_TIME,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE {DURATION} END AS PERIOD_DURATION,
         '{MO_DN_PREFIX}' || CAST(CAST(cell AS BIGINT) // 4 AS VARCHAR) AS MO_DN, cell AS MO_DN2,
         CAST(l_quantity AS BIGINT) AS pdcp_sdu_vol_ul, l_extendedprice / 100 AS pdcp_data_rate_max_ul,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount * 100 END AS pdcp_data_rate_max_dl,
         l_tax * 100 AS IP_TPUT_TIME_UL_QCI_6
  FROM kl)"""

ERIC_LTE_WIDE_SQL = "ew AS (\n  SELECT *,\n" + ",\n".join(
    f"         {'CASE WHEN pmRrcConnMax IS NULL THEN NULL ELSE ' if i % 5 == 0 else ''}"
    f"pmRrcConnEstabAtt * {i % 7 + 1} + pmHoPrepAtt{' END' if i % 5 == 0 else ''} AS {WIDE_PREFIX}{i}"
    for i in range(WIDE_COUNTERS)) + "\n  FROM el)"


def nokia_ids(k: DataFrame, tech: str, source_keyed: bool = False) -> list[Column]:
    """Identity columns of a Nokia family on records of ``kc``."""
    u = F.col("cell").cast("bigint")
    if tech == "umts":
        ids = [_lbl("RNC-", u % 7).alias("BASEID"), _lbl("WCEL-", u % 11).alias("LOCALMOID"),
               F.col("cell").alias("CELL_ID_1"), _lbl("C", u % 2).alias("CELL_ID_2")]
    else:
        mo = (_lbl("SRC-", F.col("event_id") % 3).alias("MO_DN_Source") if source_keyed
              else _lbl(MO_DN_PREFIX, u % 50).alias("MO_DN"))
        ids = [mo, F.col("cell").alias("MO_DN2")]
    return [*_nokia_common(u), F.col("oss").alias("OSS"), F.col("PERIOD_START_TIME"), _event_duration(), *ids]


def nokia_rows_sql(tech: str, values: list[str], source_keyed: bool = False) -> str:
    u = "CAST(cell AS BIGINT)"
    if tech == "umts":
        ids = (f"'RNC-' || CAST({u} % 7 AS VARCHAR) AS BASEID, 'WCEL-' || CAST({u} % 11 AS VARCHAR) AS LOCALMOID, "
               f"cell AS CELL_ID_1, 'C' || CAST({u} % 2 AS VARCHAR) AS CELL_ID_2")
    else:
        mo = ("'SRC-' || CAST(event_id % 3 AS VARCHAR) AS MO_DN_Source" if source_keyed
              else f"'{MO_DN_PREFIX}' || CAST({u} % 50 AS VARCHAR) AS MO_DN")
        ids = f"{mo}, cell AS MO_DN2"
    return f"""nr AS (
  SELECT {_nokia_common_sql(u)}, oss AS OSS, PERIOD_START_TIME, {_EVENT_DURATION_SQL}, {ids},
         {", ".join(values)}
  FROM kc)"""


UMTS_WIDE_COUNTERS = 48


def eric_umts_wide(r: DataFrame, n: int = UMTS_WIDE_COUNTERS) -> DataFrame:
    """Rows of :func:`eric_umts_rows` (enriched or not) with the wide layout's bins."""
    qty, line, returned = F.col(ERIC_UMTS_COUNTERS[1]), F.col("Cntr"), F.col(ERIC_UMTS_COUNTERS[0]).isNull()
    return r.select("*", *[_wide_bin(i, qty, line, returned).alias(f"{WIDE_PREFIX}{i}") for i in range(n)])


def eric_umts_wide_rows(spark: SparkSession, sf: str, n: int = UMTS_WIDE_COUNTERS) -> DataFrame:
    return eric_umts_wide(eric_umts_rows(spark, sf), n)


ERIC_UMTS_WIDE_SQL = "euw AS (\n  SELECT *,\n" + ",\n".join(
    f"         {f'CASE WHEN {ERIC_UMTS_COUNTERS[0]} IS NULL THEN NULL ELSE ' if i % 5 == 0 else ''}"
    f"{ERIC_UMTS_COUNTERS[1]} * {i % 7 + 1} + Cntr{' END' if i % 5 == 0 else ''} AS {WIDE_PREFIX}{i}"
    for i in range(UMTS_WIDE_COUNTERS)) + "\n  FROM eu)"

"""Mapping of the driver's TPC-H-like tables onto the counter data model.

Every relation exists twice — as a Spark DataFrame builder and as the
equivalent DuckDB SQL (a CTE) — so each catalogue query can be checked
against an independent engine on the same parquet files.

* ``kc``  counters from ``events``: one row per event = one managed-object
  record; cell = user, OSS name in mixed case, 15-minute reporting period.
* ``kl``  bulk counters from ``lineitem``: cell = supplier, period =
  ship date + line-number hours + a quarter-hour from the order key.
* ``cl``  cell lookup from ``customer ⋈ nation ⋈ region`` (one row per
  customer = cell). Cells of the HOUSEHOLD segment are registered under a
  retired OSS, so their counters stay unmatched ('unassigned').
* ``sl``  cell lookup for ``kl`` from ``supplier ⋈ nation ⋈ region``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.functions.scalars import quarter_hour

# Fixed values of the mapping (shared by the Spark and the SQL side).
RETIRED_OSS = "OSS9"
RETIRED_SEGMENT = "HOUSEHOLD"
NOKIA_SEGMENTS = ("BUILDING", "MACHINERY")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kc(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    uid, eid = F.col("user_id"), F.col("event_id")
    num = (uid % 4).cast("string")
    oss = (F.when(eid % 97 == 0, F.lit(None).cast("string"))
            .when(uid % 2 == 1, F.concat(F.lit("oss"), num))
            .otherwise(F.concat(F.lit("OSS"), num)))
    v = F.col("value")
    v_str = (F.when(eid % 10 == 3, F.lit("x")).when(eid % 10 == 7, F.lit(""))
              .when(eid % 10 == 5, F.concat(F.lit(" "), v.cast("string"), F.lit(" ")))
              .otherwise(v.cast("string")))
    return e.select(
        eid.alias("event_id"),
        oss.alias("oss"),
        uid.cast("string").alias("cell"),
        F.concat(F.when(uid % 3 == 0, F.lit("U")).otherwise(F.lit("P")), uid.cast("string")).alias("ucell"),
        quarter_hour(ts).alias("PERIOD_START_TIME"),
        F.date_trunc("hour", ts).alias("HL_DATE"),
        F.col("event_type").alias("pk_ft"),
        v.alias("value"),
        F.lit(1).cast("bigint").alias("cnt"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(v).alias("v_null"),
        v_str.alias("v_str"),
    )


KC_SQL = """kc AS (
  SELECT event_id,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN user_id % 2 = 1 THEN 'oss' || CAST(user_id % 4 AS VARCHAR)
              ELSE 'OSS' || CAST(user_id % 4 AS VARCHAR) END AS oss,
         CAST(user_id AS VARCHAR) AS cell,
         CASE WHEN user_id % 3 = 0 THEN 'U' ELSE 'P' END || CAST(user_id AS VARCHAR) AS ucell,
         time_bucket(INTERVAL '15 minutes', ts) AS PERIOD_START_TIME,
         date_trunc('hour', ts) AS HL_DATE,
         event_type AS pk_ft,
         value,
         CAST(1 AS BIGINT) AS cnt,
         CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v_null,
         CASE WHEN event_id % 10 = 3 THEN 'x' WHEN event_id % 10 = 7 THEN ''
              WHEN event_id % 10 = 5 THEN ' ' || CAST(value AS VARCHAR) || ' '
              ELSE CAST(value AS VARCHAR) END AS v_str
  FROM events)"""


def cl(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("c_custkey").cast("string")
    return j.select(
        key.alias("CELL"), key.alias("CELL_UID"),
        F.col("c_name").alias("SITE"), F.col("n_name").alias("CLUSTER"),
        F.col("c_mktsegment").alias("AREA"), F.col("r_name").alias("MARKET"),
        F.lower(F.substring("r_name", 1, 3)).alias("MARKET_SUFFIX"),
        F.when(F.col("c_mktsegment") == RETIRED_SEGMENT, F.lit(RETIRED_OSS))
         .otherwise(F.concat(F.lit("OSS"), (F.col("c_custkey") % 4).cast("string"))).alias("OSS"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("LTE")).otherwise(F.lit("UMTS")).alias("TECH"),
        F.when(F.col("c_mktsegment").isin(*NOKIA_SEGMENTS), F.lit("Nokia")).otherwise(F.lit("Ericsson")).alias("VENDOR"),
    )


CL_SQL = f"""cl AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS CELL, CAST(c.c_custkey AS VARCHAR) AS CELL_UID,
         c.c_name AS SITE, n.n_name AS CLUSTER, c.c_mktsegment AS AREA, r.r_name AS MARKET,
         lower(substr(r.r_name, 1, 3)) AS MARKET_SUFFIX,
         CASE WHEN c.c_mktsegment = '{RETIRED_SEGMENT}' THEN '{RETIRED_OSS}'
              ELSE 'OSS' || CAST(c.c_custkey % 4 AS VARCHAR) END AS OSS,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'LTE' ELSE 'UMTS' END AS TECH,
         CASE WHEN c.c_mktsegment IN {NOKIA_SEGMENTS!r} THEN 'Nokia' ELSE 'Ericsson' END AS VENDOR
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def sl(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    key = F.col("s_suppkey").cast("string")
    return j.select(
        key.alias("CELL"), key.alias("CELL_UID"),
        F.col("s_name").alias("SITE"), F.col("n_name").alias("CLUSTER"),
        F.when(F.col("s_acctbal") < 0, F.lit("DEBIT")).otherwise(F.lit("CREDIT")).alias("AREA"),
        F.col("r_name").alias("MARKET"),
        F.lower(F.substring("r_name", 1, 3)).alias("MARKET_SUFFIX"),
        F.concat(F.lit("OSS"), (F.col("s_suppkey") % 4).cast("string")).alias("OSS"),
    )


SL_SQL = """sl AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS CELL, CAST(s.s_suppkey AS VARCHAR) AS CELL_UID,
         s.s_name AS SITE, n.n_name AS CLUSTER,
         CASE WHEN s.s_acctbal < 0 THEN 'DEBIT' ELSE 'CREDIT' END AS AREA,
         r.r_name AS MARKET, lower(substr(r.r_name, 1, 3)) AS MARKET_SUFFIX,
         'OSS' || CAST(s.s_suppkey % 4 AS VARCHAR) AS OSS
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

# Quantity histogram of the bulk counters: bin i counts lines with
# floor(quantity / 10) = i, the last bin takes everything above.
QTY_BINS = 5


def kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    pst = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        hours=F.col("l_linenumber"), mins=((F.col("l_orderkey") % 4) * 15).cast("int"))
    qbin = F.least(F.floor(F.col("l_quantity") / 10), F.lit(QTY_BINS - 1))
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.concat(F.lit("OSS"), (F.col("l_suppkey") % 4).cast("string")).alias("oss"),
        F.col("l_suppkey").cast("string").alias("cell"),
        pst.alias("PERIOD_START_TIME"),
        F.date_trunc("hour", pst).alias("HL_DATE"),
        F.concat(F.lit("li_"), F.lower(F.col("l_returnflag"))).alias("pk_ft"),
        F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"),
        F.col("l_returnflag"),
        *[F.when(qbin == i, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(f"qbin_{i}") for i in range(QTY_BINS)],
    )


KL_SQL = "kl AS (\n  SELECT l_orderkey, l_linenumber,\n" \
    "         'OSS' || CAST(l_suppkey % 4 AS VARCHAR) AS oss,\n" \
    "         CAST(l_suppkey AS VARCHAR) AS cell,\n" \
    "         l_shipdate + to_hours(l_linenumber) + to_minutes(CAST((l_orderkey % 4) * 15 AS INTEGER)) AS PERIOD_START_TIME,\n" \
    "         date_trunc('hour', l_shipdate + to_hours(l_linenumber) + to_minutes(CAST((l_orderkey % 4) * 15 AS INTEGER))) AS HL_DATE,\n" \
    "         'li_' || lower(l_returnflag) AS pk_ft,\n" \
    "         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,\n" + ",\n".join(
        f"         CAST(CASE WHEN least(floor(l_quantity / 10), {QTY_BINS - 1}) = {i} THEN 1 ELSE 0 END AS BIGINT) AS qbin_{i}"
        for i in range(QTY_BINS)) + "\n  FROM lineitem)"


def kc_layout(df: DataFrame, vendor: str, tech: str) -> DataFrame:
    """Rename the generic counter columns to a vendor's input layout."""
    if vendor == "ericsson":
        cell = "EUtranCellFDD" if tech == "lte" else "UtranCell"
        return (df.withColumnRenamed("oss", "OSSName").withColumnRenamed("cell", cell)
                  .withColumn("HL_MARKET", F.lit("stale")))
    cell = "MO_DN2" if tech == "lte" else "CELL_ID_1"
    return df.withColumnRenamed("oss", "OSS").withColumnRenamed("cell", cell)

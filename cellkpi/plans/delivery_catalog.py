"""Catalogue entries for deliveries as they come: columns in any order, rows too late."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellkpi.plans import driver_tables as dt
from cellkpi.plans.catalog import _CSV_SCHEMA, _READ_SQL, _kc_file_rows, _ts, _w, _write_delimited, finish, q
from cellkpi.session import scratch_path, write_text_file
from cellkpi.sources.headers import header_drift, read_by_header
from cellkpi.sources.schema import typed_from_strings
from cellkpi.streaming.hourly import hourly_window_reopened, read_reopened_windows

_FIRST_HALF = "PERIOD_START_TIME < TIMESTAMP '2024-01-16 00:00:00'"


def _deliveries(spark, sf) -> list[str]:
    """The records as the folders and files of three releases: the registered order; another
    order, other case and a column more; and a file of only a header."""
    rows = dt.kc_layout(dt.kc(spark, sf), "ericsson", "lte").select(*_CSV_SCHEMA.names, "v_str")
    old = _write_delimited(rows.where(_FIRST_HALF).drop("v_str"), scratch_path(spark, "release-a"), ",")
    new = rows.where(f"NOT ({_FIRST_HALF})").select("value", "v_str", "PERIOD_START_TIME", F.col("EUtranCellFDD").alias("eutrancellfdd"),
                                                    F.col("OSSName").alias("OSSNAME"), "event_id")
    bare = write_text_file(spark, f"{scratch_path(spark, 'release-c')}/header only.csv", "OSSName,event_id,value,pmNew\n")
    return [old, _write_delimited(new, scratch_path(spark, "release-b"), ","), bare]


@q("read_by_header", _READ_SQL)
def read_by_header_q(spark, sf):
    return finish(read_by_header(spark, _deliveries(spark, sf), _CSV_SCHEMA))


@q("read_without_schema", _w(dt.KC_SQL) + f"""SELECT event_id, oss AS OSSName, cell AS EUtranCellFDD, {_ts('PERIOD_START_TIME')} AS PERIOD_START_TIME,
  round(value, 4) AS value, round(CASE WHEN {_FIRST_HALF} THEN NULL ELSE try_cast(v_str AS DOUBLE) END, 4) AS v_str, CAST(NULL AS DOUBLE) AS "pmNew" FROM kc""")
def read_without_schema(spark, sf):
    """Columns known from the files' headers alone, counters typed afterwards."""
    text = read_by_header(spark, _deliveries(spark, sf))
    typed = typed_from_strings(text, identity=["event_id", "OSSName", "EUtranCellFDD", "PERIOD_START_TIME"])
    names = {c.lower(): c for c in typed.columns}
    period = F.to_timestamp(names["period_start_time"], "yyyy-MM-dd HH:mm")
    return finish(typed.select(F.col(names["event_id"]).cast("long").alias("event_id"), F.col(names["ossname"]).alias("OSSName"),
                               F.col(names["eutrancellfdd"]).alias("EUtranCellFDD"), period.alias("PERIOD_START_TIME"), "value", "v_str", "pmNew"))


@q("header_drift", _w(dt.KC_SQL) + f"""SELECT 'eutrancellfdd,period_start_time' AS missing, 'pmnew' AS "unknown", true AS reordered, CAST(1 AS BIGINT) AS n_releases
UNION ALL SELECT '', 'v_str', true, CAST(1 AS BIGINT) WHERE EXISTS (SELECT 1 FROM kc WHERE NOT ({_FIRST_HALF}))""")
def header_drift_q(spark, sf):
    """Releases whose header differs from the registered schema (files of the same drift counted once)."""
    drift = header_drift(spark, _deliveries(spark, sf), _CSV_SCHEMA)
    return drift.groupBy(F.array_join("missing", ",").alias("missing"), F.array_join("unknown", ",").alias("unknown"), "reordered").agg(
        F.count_distinct(F.regexp_replace("path", "/[^/]*$", "")).alias("n_releases"))


_DELIVERIES, _LATENESS = 3, "2 days"


@q("tumbling_hour_late", _w(dt.KC_SQL, f"d AS (SELECT *, event_id % {_DELIVERIES} AS d, time_bucket(INTERVAL '1 hour', PERIOD_START_TIME) AS w FROM kc)",
   "newest AS (SELECT d, max(PERIOD_START_TIME) AS m FROM d GROUP BY d)",
   f"limits AS (SELECT a.d, max(b.m) - INTERVAL {_LATENESS} AS lim FROM newest a LEFT JOIN newest b ON b.d < a.d GROUP BY a.d)") +
   f"""SELECT {_ts('w')} AS window_start, cell, round(sum(value), 4) AS value, count(*) AS n_rows,
  CAST(count(*) FILTER (coalesce(w + INTERVAL '1 hour' <= lim, false)) AS BIGINT) AS n_late
FROM d JOIN limits USING (d) GROUP BY w, cell""")
def tumbling_hour_late(spark, sf):
    """Three deliveries that each span the whole month, so that most rows of the second and the
    third are later than the lateness: every hour is reopened and nothing is dropped."""
    src, out, ckpt = (scratch_path(spark, f"late-{x}") for x in ("src", "log", "ckpt"))
    rows = dt.kc(spark, sf).select("event_id", "cell", "PERIOD_START_TIME", "value")
    for i in range(_DELIVERIES):
        rows.where(F.col("event_id") % _DELIVERIES == i).drop("event_id").write.mode("append").parquet(src)
        query = hourly_window_reopened(spark.readStream.schema("cell string, PERIOD_START_TIME timestamp, value double").parquet(src),
                                       out, ckpt, lateness=_LATENESS)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    return finish(read_reopened_windows(spark, out))

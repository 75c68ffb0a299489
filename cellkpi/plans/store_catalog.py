"""Catalogue entries for stores of many families, landing of many families,
quarantine, rebuilds and reruns, join routes and text specs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.operators import select as sel
from cellkpi.operators.aggregate import hour_and_day
from cellkpi.operators.enrich import ERIC_LTE_ATTRS, derive_hl_date, enrich
from cellkpi.plans import driver_tables as dt
from cellkpi.plans import families as fam
from cellkpi.plans import vendor_tables as vt
from cellkpi.plans.catalog import AS_OF, BASE, IDX_SQL, KC_SPEC, LATEST_N, LATEST_SQL, SQL, _ts, _w, finish, index, q, store
from cellkpi.plans.jobs import (enrich_with_pk, export_report, ingest, ingest_families, quarantine_of, report, report_families, report_sql,
                                report_sql_daily, with_export_key)
from cellkpi.plans.sparse import report_sparse, write_sparse
from cellkpi.session import scratch_path
from cellkpi.sources.copartitioned import enrich_copartitioned, write_copartitioned
from cellkpi.sources.export import read_export
from cellkpi.sources.lookup import build_lookup
from cellkpi.sources.schema import SchemaRegistry
from cellkpi.sources.store import read_family, read_store

# --------------------------------------------------------- several families

FAMILY_COUNTERS = {
    "lte_cell_load": ("rach_stp_att_small_msg",),
    "lte_isys_ho_gsm_nb_sum": ("ISYS_HO_GERAN_SRVCC_ATT_NB", "ISYS_HO_GERAN_SRVCC_FAIL_NB"),
    "lte_cell_throughput": ("pdcp_sdu_vol_ul",),
}
_NOKIA_KEYS = dict(oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID", date_col="PERIOD_START_TIME",
                   hour_col="PERIOD_START_TIME")


def family_frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Rows of three families with columns of their own, from ``events``."""
    k = dt.kc(spark, sf)
    u = F.col("cell").cast("bigint")
    volume = k.select(*vt._nokia_common(u), F.col("oss").alias("OSS"), "PERIOD_START_TIME", vt._event_duration(),
                      vt._lbl(vt.MO_DN_PREFIX, u % 50).alias("MO_DN"), F.col("cell").alias("MO_DN2"),
                      F.floor("value").cast("bigint").alias("pdcp_sdu_vol_ul"))
    frames = (vt.nokia_cell_load_rows(spark, sf), vt.nokia_gsm_nb_rows(spark, sf), volume)
    return dict(zip(FAMILY_COUNTERS, frames, strict=True))


def _long(rep: DataFrame, family: str) -> DataFrame:
    keys = ["pk_market", "pk_date", "pk_hr"]
    sums = rep.groupBy(*keys).agg(*[F.sum(c).cast("double").alias(c) for c in FAMILY_COUNTERS[family]])
    pairs = ", ".join(f"'{c}', {c}" for c in FAMILY_COUNTERS[family])
    return sums.select(F.lit(family).alias("family"), *keys,
                       F.expr(f"stack({len(FAMILY_COUNTERS[family])}, {pairs}) AS (counter, value)"))


_NE_SQL = """ne AS (
  SELECT k.*, IFNULL(l.MARKET, 'unassigned') AS pk_market, strftime(k.PERIOD_START_TIME, '%Y-%m-%d') AS pk_date,
         strftime(k.PERIOD_START_TIME, '%H') AS pk_hr
  FROM kc k LEFT JOIN cl l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL_UID)"""
_FAMILY_VALUES = (("lte_cell_load", "rach_stp_att_small_msg", "value"),
                  ("lte_isys_ho_gsm_nb_sum", "ISYS_HO_GERAN_SRVCC_ATT_NB", "value"),
                  ("lte_isys_ho_gsm_nb_sum", "ISYS_HO_GERAN_SRVCC_FAIL_NB", "v_null"),
                  ("lte_cell_throughput", "pdcp_sdu_vol_ul", "CAST(floor(value) AS BIGINT)"))


@q("multi_family_report", _w(dt.KC_SQL, dt.CL_SQL, _NE_SQL, f"""lat AS (
  SELECT *, row_number() OVER (PARTITION BY pk_market ORDER BY pk_date DESC, pk_hr DESC) AS rk
  FROM (SELECT DISTINCT pk_market, pk_date, pk_hr FROM ne) QUALIFY rk <= {LATEST_N})""",
   "sel AS (SELECT ne.* FROM ne SEMI JOIN lat USING (pk_market, pk_date, pk_hr))") + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS family, pk_market, pk_date, pk_hr, '{c}' AS counter, round(CAST(sum({v}) AS DOUBLE), 4) AS value "
    "FROM sel GROUP BY pk_market, pk_date, pk_hr" for f, c, v in _FAMILY_VALUES))
def multi_family_report(spark, sf):
    """Families with different columns in one store, each reported from its own
    directory over its registered counters."""
    frames = family_frames(spark, sf)
    registry = SchemaRegistry({f: df.schema for f, df in frames.items()})
    path = scratch_path(spark, "family-store")
    stamped = {f: derive_hl_date(df) for f, df in frames.items()}
    ingest_families(stamped, registry, dt.cl(spark, sf), path, attrs={
        "HL_Sector": "CELL", "HL_Site": "SITE", "HL_Market": "MARKET", "HL_Cluster": "CLUSTER", "HL_Area": "AREA"},
        **_NOKIA_KEYS)
    specs = {f: fam.nokia_lte(f.removeprefix("lte_")) for f in frames}
    parts = [_long(rep, f) for f, rep in report_families(spark, path, specs, registry, latest_n=LATEST_N).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return finish(out)


@q("sparse_family_report", SQL["multi_family_report"])
def sparse_family_report(spark, sf):
    """The same families in one table of maps: one scan and one aggregate report all of them."""
    attrs = {"HL_Sector": "CELL", "HL_Site": "SITE", "HL_Market": "MARKET", "HL_Cluster": "CLUSTER", "HL_Area": "AREA"}
    lookup, path = dt.cl(spark, sf), scratch_path(spark, "sparse-store")
    frames = {f: enrich_with_pk(derive_hl_date(df), lookup, attrs=attrs, **_NOKIA_KEYS) for f, df in family_frames(spark, sf).items()}
    write_sparse(frames, path)
    specs = {f: fam.nokia_lte(f.removeprefix("lte_")) for f in frames}
    reports = report_sparse(spark, path, specs, {f: df.schema for f, df in frames.items()}, latest_n=LATEST_N)
    return finish(reduce(DataFrame.unionByName, [_long(rep, f) for f, rep in reports.items()]))


def _deliver(lines: DataFrame, folder: str, name: str) -> None:
    """Write lines as delivery files called ``<number>_..._<name>.txt``."""
    spark = lines.sparkSession
    stage = scratch_path(spark, "delivery")
    lines.write.text(stage)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    parts = [s.getPath() for s in fs.listStatus(path(stage)) if s.getPath().getName().startswith("part-")]
    for i, p in enumerate(parts):
        fs.rename(p, path(f"{folder}/A{i}_NOKIA_LTE_20240105_100000000_TMO_{name}.txt"))


def _as_lines(df: DataFrame) -> DataFrame:
    cols = [F.date_format(c, "yyyy-MM-dd HH:mm") if t.startswith("timestamp") else F.col(c).cast("string") for c, t in df.dtypes]
    body = df.select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols]).alias("value"))
    head = df.sparkSession.range(1).select(F.lit("|".join(df.columns)).alias("value"))
    return head.unionByName(body)


@q("landing_families", _w(dt.KC_SQL, dt.CL_SQL, _NE_SQL) + """
SELECT 'lte_cell_load' AS pk_ft, pk_date, pk_market, count(*) AS n_rows, round(sum(value), 4) AS value
FROM ne GROUP BY pk_date, pk_market
UNION ALL
SELECT 'lte_isys_ho_gsm_nb_sum', pk_date, pk_market, count(*), round(sum(v_null), 4) FROM ne GROUP BY pk_date, pk_market
UNION ALL SELECT 'lte_not_registered', '', '', count(*) + 1, NULL FROM kc WHERE pk_ft = 'view'""")
def landing_families(spark, sf):
    """Files of several families landed from one folder by two streams; the second
    starts with a checkpoint of its own and must not replace what the first wrote."""
    from cellkpi.streaming.landing import land_families
    frames = {f: df for f, df in family_frames(spark, sf).items() if f != "lte_cell_throughput"}
    registry = SchemaRegistry({f: df.schema for f, df in frames.items()})
    path, lookup = scratch_path(spark, "landed-families"), dt.cl(spark, sf)
    for family, df in frames.items():
        src = scratch_path(spark, f"landing-{family}")
        _deliver(_as_lines(df), src, family)
        if family == "lte_cell_load":
            _deliver(_as_lines(dt.kc(spark, sf).where("pk_ft = 'view'").select("cell")), src, "lte_not_registered")
        query = land_families(spark, src, registry, lookup, path, scratch_path(spark, "landing-ckpt"),
                              enrich_kw=dict(attrs={"HL_Market": "MARKET"}, **_NOKIA_KEYS), max_files_per_trigger=2)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    out = spark.read.parquet(f"{quarantine_of(path)}/files").groupBy("pk_ft").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "pk_ft", F.lit("").alias("pk_date"), F.lit("").alias("pk_market"), "n_rows", F.lit(None).cast("double").alias("value"))
    for family, counter in (("lte_cell_load", "rach_stp_att_small_msg"), ("lte_isys_ho_gsm_nb_sum", "ISYS_HO_GERAN_SRVCC_FAIL_NB")):
        landed = read_family(spark, path, family, registry[family])
        out = out.unionByName(landed.groupBy("pk_ft", "pk_date", "pk_market").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(counter).alias("value")))
    return finish(out)


# ------------------------------------------- nothing is lost, nothing is stale

@q("ingest_quarantine", _w(dt.KC_SQL) + """SELECT kind, count(*) AS n_rows, round(sum(value), 4) AS value FROM (
  SELECT value, CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 THEN 'quarantined'
                     ELSE 'stored' END AS kind FROM kc) GROUP BY kind""")
def ingest_quarantine(spark, sf):
    """Rows without a date, a period or a family are quarantined, all others stored."""
    k, eid = dt.kc(spark, sf), F.col("event_id")
    dirty = k.withColumns({"HL_DATE": F.when(eid % 17 != 0, F.col("HL_DATE")),
                           "PERIOD_START_TIME": F.when(eid % 19 != 0, F.col("PERIOD_START_TIME")),
                           "pk_ft": F.when(eid % 23 != 0, F.col("pk_ft")).otherwise("")})
    path = scratch_path(spark, "dirty-store")
    ingest(dirty, dt.cl(spark, sf), path, oss_col="oss", cell_col="cell", lookup_cell_col="CELL", attrs=ERIC_LTE_ATTRS,
           date_col="HL_DATE", hour_col="PERIOD_START_TIME")
    both = read_store(spark, path).select(F.lit("stored").alias("kind"), "value").unionByName(
        spark.read.parquet(quarantine_of(path)).select(F.lit("quarantined").alias("kind"), "value"))
    return finish(both.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value")))


@q("enrich_routes", _w(dt.KC_SQL, dt.CL_SQL, """odd AS (
  SELECT event_id, oss, user_key, CASE WHEN user_key % 5 = 0 THEN '' ELSE CAST(user_key AS VARCHAR) END AS cell
  FROM (SELECT event_id, oss, CAST(cell AS BIGINT) AS user_key FROM kc)), padded AS (
  SELECT DISTINCT CASE WHEN CAST(CELL AS BIGINT) % 3 = 0 THEN '0' || CELL WHEN CAST(CELL AS BIGINT) % 7 = 0 THEN '' ELSE CELL END AS CELL,
         OSS, MARKET FROM cl),
one AS (SELECT CELL, OSS, min(MARKET) AS MARKET FROM padded GROUP BY CELL, OSS),
joined AS (
  SELECT 'number' AS key_kind, IFNULL(l.MARKET, 'unassigned') AS HL_Market FROM odd k
  LEFT JOIN one l ON upper(k.oss) = upper(l.OSS) AND CAST(k.user_key AS VARCHAR) = l.CELL
  UNION ALL
  SELECT 'text', IFNULL(l.MARKET, 'unassigned') FROM odd k LEFT JOIN one l ON upper(k.oss) = upper(l.OSS) AND k.cell = l.CELL)""") + """
SELECT route, key_kind, HL_Market, count(*) AS n_rows FROM joined, (VALUES ('broadcast'), ('shuffled')) r(route)
GROUP BY route, key_kind, HL_Market""")
def enrich_routes(spark, sf):
    """Both join routes give the same rows for numeric, padded and empty cell keys."""
    number = F.col("CELL").cast("bigint")
    lookup = dt.cl(spark, sf).withColumn("CELL", F.when(number % 3 == 0, F.concat(F.lit("0"), "CELL"))
                                         .when(number % 7 == 0, F.lit("")).otherwise(F.col("CELL")))
    odd = dt.kc(spark, sf).select("event_id", "oss", F.col("cell").cast("bigint").alias("user_key")).withColumn(
        "cell", F.when(F.col("user_key") % 5 == 0, F.lit("")).otherwise(F.col("user_key").cast("string")))
    out = None
    for route, rows in (("broadcast", 5_000_000), ("shuffled", 0)):
        for kind, col in (("number", "user_key"), ("text", "cell")):
            e = enrich(odd, lookup, oss_col="oss", cell_col=col, lookup_cell_col="CELL", attrs={"HL_Market": "MARKET"},
                       broadcast_rows=rows).select(F.lit(route).alias("route"), F.lit(kind).alias("key_kind"), "HL_Market")
            out = e if out is None else out.unionByName(e)
    return out.groupBy("route", "key_kind", "HL_Market").agg(F.count(F.lit(1)).alias("n_rows"))


@q("enrich_copartitioned", _w(dt.KC_SQL, dt.CL_SQL, """one AS (
  SELECT upper(OSS) AS OSS, CELL, min(MARKET) AS MARKET, min(CLUSTER) AS CLUSTER FROM cl GROUP BY ALL)""") + """
SELECT k.event_id, k.pk_ft, IFNULL(l.MARKET, 'unassigned') AS HL_Market, IFNULL(l.CLUSTER, 'unassigned') AS HL_Cluster,
  round(k.value, 4) AS value
FROM kc k LEFT JOIN one l ON upper(k.oss) = l.OSS AND k.cell = l.CELL""")
def enrich_copartitioned_q(spark, sf):
    """Counters dealt into buckets by (OSS, cell) in two batches, joined with the lookup
    without an exchange of theirs; cells with many records are dealt under several keys."""
    rows, path = dt.kc(spark, sf).select("event_id", "oss", "cell", "value", "pk_ft"), scratch_path(spark, "copartitioned")
    for batch, part in (("b0", "event_id % 3 <> 0"), ("b1", "event_id % 3 = 0")):
        write_copartitioned(rows.where(part), path, batch, oss_col="oss", cell_col="cell", buckets=8, partition_by=("pk_ft",), hot_rows=64)
    out = enrich_copartitioned(spark, path, dt.cl(spark, sf), lookup_cell_col="CELL", attrs={"HL_Market": "MARKET", "HL_Cluster": "CLUSTER"})
    return finish(out.select("event_id", "pk_ft", "HL_Market", "HL_Cluster", "value"))


@q("lookup_rebuild_moved_cell", _w(dt.CL_SQL) + """SELECT TECH, VENDOR, CELL, OSS, SITE,
  CASE WHEN CAST(CELL AS BIGINT) % 4 = 0 THEN 'MOVED' ELSE MARKET END AS MARKET FROM cl""")
def lookup_rebuild_moved_cell(spark, sf):
    """A rebuilt lookup holds each cell once, in the market it moved to."""
    path, lookup = scratch_path(spark, "lookup-rebuilt"), dt.cl(spark, sf)
    build_lookup(lookup, path)
    build_lookup(lookup.withColumn("MARKET", F.when(F.col("CELL").cast("bigint") % 4 == 0, F.lit("MOVED"))
                                   .otherwise(F.col("MARKET"))), path)
    back = spark.read.parquet(path)
    return back.select("TECH", "VENDOR", F.col("CELL").cast("string"), "OSS", "SITE", "MARKET")


@q("export_rerun", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + f"""
SELECT pk_market, pk_date, pk_hr, pk_ft, cell, {_ts('HL_DATE')} AS PERIOD_START_TIME, round(sum(value), 4) AS value
FROM ekc SEMI JOIN (SELECT * FROM lat WHERE hour_rank = 1) USING (pk_ft, pk_date, pk_market, pk_hr)
GROUP BY pk_market, pk_date, pk_hr, pk_ft, cell, HL_DATE, HL_Cluster, HL_Area""")
def export_rerun(spark, sf):
    """An export run again holds the keys, values and stamps of the last run only."""
    path = scratch_path(spark, "export-rerun")
    for hours in (LATEST_N, 1):
        r = report(store(spark, sf), KC_SPEC, latest_n=hours, grain="hour", index=index(spark, sf))
        export_report(with_export_key(r.select("pk_market", "pk_date", "pk_hr", "pk_ft", F.col("pk_hr").alias("hr"),
                                               F.col("pk_date").alias("day"), "cell", "PERIOD_START_TIME", "value"),
                                      dt.cl(spark, sf)), path)
    back = read_export(spark, path)
    return finish(back.select("pk_market", F.col("day").alias("pk_date"), F.lpad("hr", 2, "0").alias("pk_hr"), "pk_ft", "cell",
                              "PERIOD_START_TIME", F.col("value").cast("double").alias("value")))


# ------------------------------------------------------------------ text specs

TEXT_SELECT = ("'unassigned' as MGR_RUN_ID, hl_date as PERIOD_START_TIME, cell, max(v_str) as v_max, avg(v_str) as v_avg, "
               "SUM(IFNULL(v_null,0)) as v_sum, sum(value)")
_TEXT_SQL = ("cell, round(max(try_cast(trim(v_str) AS DOUBLE)), 4) AS v_max, round(avg(try_cast(trim(v_str) AS DOUBLE)), 4) AS v_avg, "
             "round(sum(ifnull(v_null, 0)), 4) AS v_sum, round(sum(value), 4) AS value, pk_ft, pk_date, pk_market")


def _text_store(spark, sf):
    return store(spark, sf).withColumn("hl_date_text", F.col("HL_DATE").cast("string"))


@q("text_spec_hourly", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + f"""
SELECT {_ts('HL_DATE')} AS PERIOD_START_TIME, {_TEXT_SQL}, pk_hr
FROM ekc SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr) GROUP BY HL_DATE, cell, pk_ft, pk_date, pk_market, pk_hr""")
def text_spec_hourly(spark, sf):
    """A feature-file spec over text counters: MAX and AVG compare numbers, junk is
    NULL, an aggregate without an alias has its counter's name."""
    return finish(report_sql(store(spark, sf), TEXT_SELECT, "hl_date, cell", latest_n=LATEST_N, index=index(spark, sf))
                  .drop("MGR_RUN_ID"))


@q("text_spec_daily", BASE.rstrip("\n") + f""",
lat AS (SELECT pk_ft, pk_market, max(pk_date) AS pk_date FROM ekc GROUP BY pk_ft, pk_market)
SELECT {_ts("date_trunc('day', HL_DATE)")} AS PERIOD_START_TIME, {_TEXT_SQL}
FROM ekc SEMI JOIN lat USING (pk_ft, pk_date, pk_market) GROUP BY date_trunc('day', HL_DATE), cell, pk_ft, pk_date, pk_market""")
def text_spec_daily(spark, sf):
    """The same spec rolled up to the newest day of every market."""
    return finish(report_sql_daily(store(spark, sf), TEXT_SELECT, "hl_date, cell", time_keys=("hl_date",), index=index(spark, sf))
                  .drop("MGR_RUN_ID"))


# ------------------------------------------------------------- small operators

@q("hour_and_day_totals", BASE + """SELECT coalesce(pk_hr, '') AS pk_hr, pk_date, pk_market,
  CASE WHEN grouping(pk_hr) = 1 THEN 'day' ELSE 'hour' END AS grain, round(sum(value), 4) AS value, count(*) AS n_rows
FROM ekc GROUP BY GROUPING SETS ((pk_date, pk_hr, pk_market), (pk_date, pk_market))""")
def hour_and_day_totals(spark, sf):
    """Hourly and daily totals in one pass."""
    out = hour_and_day(store(spark, sf), ["pk_market"], [F.sum("value").alias("value"), F.count(F.lit(1)).alias("n_rows")])
    return finish(out.withColumn("pk_hr", F.coalesce("pk_hr", F.lit(""))))


@q("latest_two_dates", BASE + "SELECT DISTINCT pk_date FROM ekc ORDER BY pk_date DESC LIMIT 2")
def latest_two_dates(spark, sf):
    """O2: the newest two dates of the store."""
    return sel.latest_dates(index(spark, sf), 2)


GATE_DAYS = 3


@q("report_of_fresh_markets", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + f""",
fresh AS (SELECT pk_ft, pk_market FROM ekc GROUP BY pk_ft, pk_market
          HAVING date_diff('day', CAST(max(pk_date) AS DATE), DATE '{AS_OF}') < {GATE_DAYS})
SELECT pk_ft, pk_market, pk_date, pk_hr, cell, round(sum(value), 4) AS value
FROM ekc SEMI JOIN lat USING (pk_ft, pk_date, pk_market, pk_hr) SEMI JOIN fresh USING (pk_ft, pk_market)
GROUP BY pk_ft, pk_market, pk_date, pk_hr, cell, HL_DATE, HL_Cluster, HL_Area""")
def report_of_fresh_markets(spark, sf):
    """A report leaves out markets whose newest date is too old."""
    r = report(store(spark, sf), KC_SPEC, latest_n=LATEST_N, grain="hour", index=index(spark, sf),
               fresh_as_of=AS_OF, fresh_days=GATE_DAYS)
    return finish(r.select("pk_ft", "pk_market", "pk_date", "pk_hr", "cell", "value"))


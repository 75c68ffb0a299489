"""Enrichment join semantics (J1-J4, P1, P2, dedup, unassigned)."""

from pyspark.sql import functions as F

from cellkpi.operators.enrich import (NOKIA_ATTRS, derive_hl_date, derive_pk, enrich, enrich_for,
                                      market_suffix, with_market_suffix)
from tests.fixtures import lookup_df


def _counters(spark):
    return spark.createDataFrame(
        [("oss1", "UID1", 1.0), ("OSS1", "UID2", 2.0), ("oss2", "UID3", 3.0),
         (None, "UID1", 4.0), ("OSS1", "NOPE", 5.0)],
        "OSS string, MO_DN2 string, c double")


def test_case_insensitive_oss_and_unassigned(spark):
    lk = lookup_df(spark).where("TECH='LTE' and VENDOR='Nokia'")
    out = {r.c: r for r in enrich_for(_counters(spark), lk, "nokia", "lte").collect()}
    assert out[1.0].HL_Market == "NEW YORK" and out[1.0].HL_Sector == "C1"
    assert out[3.0].HL_Market == "LONG_ISLAND/EAST"
    assert out[4.0].HL_Market == "unassigned"          # NULL OSS never matches
    assert out[5.0].HL_Cluster == "unassigned"         # unknown cell
    assert set(NOKIA_ATTRS) <= set(out[1.0].asDict())


def test_dedup_keeps_row_count_and_no_dedup_multiplies(spark):
    lk = lookup_df(spark).where("TECH='LTE' and VENDOR='Nokia'")
    c = _counters(spark)
    kw = dict(oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID", attrs={"HL_Cluster": "CLUSTER"})
    assert enrich(c, lk, dedup_lookup=True, **kw).count() == c.count()
    assert enrich(c, lk, dedup_lookup=False, **kw).count() == c.count() + 1
    # deterministic choice: smallest attribute tuple
    row = enrich(c, lk, **kw).where("c = 2.0").first()
    assert row.HL_Cluster == "CL1"


def test_unassigned_plus_matched_equals_input(spark):
    lk = lookup_df(spark).where("TECH='LTE' and VENDOR='Nokia'")
    e = enrich_for(_counters(spark), lk, "nokia", "lte")
    matched = e.where("HL_Market <> 'unassigned'").count()
    unmatched = e.where("HL_Market = 'unassigned'").count()
    assert matched + unmatched == 5 and matched == 3


def test_ericsson_drops_input_market_and_broadcasts(spark):
    lk = lookup_df(spark).where("TECH='LTE' and VENDOR='Ericsson'")
    k = spark.createDataFrame([("stale", "oss1", "C1", 1.0)], "HL_MARKET string, OSSName string, EUtranCellFDD string, c double")
    e = enrich_for(k, lk, "ericsson", "lte")
    assert [c for c in e.columns if c.lower() == "hl_market"] == ["HL_Market"]
    assert e.first().HL_Market == "NEW YORK"
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_pk_and_hl_date(spark):
    df = spark.createDataFrame([("2024-01-05 23:45:00", "2024-01-05 22:00:00", "M")],
                               "p string, h string, HL_Market string")
    df = df.select(F.to_timestamp("p").alias("PERIOD_START_TIME"), F.to_timestamp("h").alias("HL_DATE"), "HL_Market")
    r = derive_pk(df).first()
    assert (r.pk_date, r.pk_hr, r.pk_market) == ("2024-01-05", "23", "M")   # hour from period, date from HL_DATE
    r = derive_hl_date(df).first()
    assert r.HL_Date_Hour == "2024-01-05 23:00:00"


def test_market_suffix_default_null(spark):
    lk = lookup_df(spark)
    assert market_suffix(lk).count() == 3
    rows = spark.createDataFrame([("NEW YORK",), ("MARS",), ("NO SUFFIX",)], "pk_market string")
    got = {r.pk_market: r.market_suffix for r in with_market_suffix(rows, lk).collect()}
    assert got == {"NEW YORK": "nyc", "MARS": "null", "NO SUFFIX": "null"}


def test_dedup_rows_hot_key_keeps_last_delivery(spark):
    from cellkpi.operators.enrich import dedup_rows
    # one record re-delivered 3000 times (a hot key) plus two ordinary records
    rows = [("ft", 1, d, float(d)) for d in range(3000)] + [("ft", 2, 0, 5.0), ("ft", 3, 1, 7.0)]
    df = spark.createDataFrame(rows, "pk_ft string, rec long, delivery int, value double").repartition(8)
    last = {r.rec: r for r in dedup_rows(df, ["pk_ft", "rec"], ["delivery"]).collect()}
    assert len(last) == 3 and last[1].delivery == 2999 and last[1].value == 2999.0 and last[2].value == 5.0
    first = {r.rec: r for r in dedup_rows(df, ["pk_ft", "rec"], ["delivery"], keep="first").collect()}
    assert first[1].delivery == 0 and first[1].value == 0.0
    assert dedup_rows(df, ["pk_ft", "rec"], ["delivery"]).columns == df.columns
    plan = dedup_rows(df, ["pk_ft", "rec"], ["delivery"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan      # copies collapse map-side


def test_dedup_rows_ties_are_deterministic(spark):
    from cellkpi.operators.enrich import dedup_rows
    rows = [("a", 1, 9.0), ("a", 1, 3.0), ("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, delivery int, value double")
    got = {r.k: r.value for r in dedup_rows(df, ["k"], ["delivery"]).collect()}
    assert got == {"a": 9.0, "b": None}

"""Answers that must not depend on sizes, sessions, streams or text order."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.operators.enrich import dedup_rows, enrich
from cellkpi.operators.select import latest_hours
from cellkpi.operators.spec import (CounterRule, Item, KpiSpec, Measure, aggregate, aggregate_from_schema,
                                    sql_feature_aggregate, typed_measures, with_measures)
from cellkpi.plans.jobs import ingest, quarantine_of
from cellkpi.sources.lookup import build_lookup
from cellkpi.sources.schema import SchemaRegistry, schema_from_fields
from cellkpi.sources.store import read_store, write_store
from cellkpi.streaming.landing import land, land_families
from tests.fixtures import CELL_AVAIL, lookup_df, schema, write_delimited

KW = dict(oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID", attrs={"HL_Market": "MARKET"},
          date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME")
HDR = [f["name"] for f in CELL_AVAIL]


@pytest.mark.parametrize("bound", [0, 5_000_000])
def test_number_keys_match_their_digits_only(spark, bound):
    k = spark.createDataFrame([("OSS1", 7), ("OSS1", 8), (None, 7), ("OSS1", None)], "oss string, cell int")
    lk = spark.createDataFrame([("oss1", "07", "NY"), ("OSS1", "8", "LA")], "OSS string, CELL string, MARKET string")
    out = enrich(k, lk, oss_col="oss", cell_col="cell", lookup_cell_col="CELL", attrs={"HL_Market": "MARKET"}, broadcast_rows=bound)
    assert sorted((str(r.oss), str(r.cell), r.HL_Market) for r in out.collect()) == [
        ("None", "7", "unassigned"), ("OSS1", "7", "unassigned"), ("OSS1", "8", "LA"), ("OSS1", "None", "unassigned")]


def test_every_row_is_stored_or_quarantined(spark, tmp):
    rows = [(1, "2024-01-05 10:00:00", "f"), (2, None, "f"), (3, "2024-01-05 11:00:00", ""), (4, "2024-01-05 11:00:00", "g")]
    df = spark.createDataFrame(rows, "id int, t string, pk_ft string").select(
        "id", F.to_timestamp("t").alias("PERIOD_START_TIME"), "pk_ft", F.lit("OSS1").alias("OSS"), F.lit("UID1").alias("MO_DN2"))
    ingest(df, lookup_df(spark).where("VENDOR='Nokia'"), f"{tmp}/store", types=["f"], **KW)
    assert [r.id for r in read_store(spark, f"{tmp}/store").collect()] == [1]
    assert sorted(r.id for r in spark.read.parquet(quarantine_of(f"{tmp}/store")).collect()) == [2, 3, 4]


def test_overwrites_do_not_follow_the_session(spark, tmp):
    lk = spark.createDataFrame([("c1", "LTE", "N", "M1"), ("c2", "LTE", "N", "M2")], "CELL string, TECH string, VENDOR string, MARKET string")
    rows = spark.createDataFrame([("f", "2024-01-05", "m", "10", 1), ("f", "2024-01-06", "m", "10", 2)],
                                 "pk_ft string, pk_date string, pk_market string, pk_hr string, v int")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    try:
        for mode in ("dynamic", "static"):
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
            build_lookup(lk, f"{tmp}/lk-{mode}")
            build_lookup(lk.withColumn("MARKET", F.lit("M3")), f"{tmp}/lk-{mode}")
            assert [r.MARKET for r in spark.read.parquet(f"{tmp}/lk-{mode}").collect()] == ["M3", "M3"]
            write_store(rows, f"{tmp}/st-{mode}", mode="overwrite")
            write_store(rows.where("v = 2").withColumn("v", F.lit(9)), f"{tmp}/st-{mode}", mode="overwrite")
            assert sorted(r.v for r in read_store(spark, f"{tmp}/st-{mode}").collect()) == [1, 9]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def _file(folder, name, periods):
    rows = [["r", "R", "M", "OSS1", p, 900, "DN1", "UID1", 1, 2, 3, 4] for p in periods]
    return write_delimited(os.path.join(folder, name), HDR, rows, "|")


def _end(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_second_stream_and_lost_checkpoint_lose_no_row(spark, tmp):
    lk = lookup_df(spark).where("VENDOR='Nokia'")
    name = "A_NOKIA_LTE_20240105_100000000_TMO_lte_cell_avail.txt"
    _file(f"{tmp}/a", name, ["2024-01-05 10:00"])
    _file(f"{tmp}/b", name, ["2024-01-05 10:15", "bad period"])
    for src, ck in (("a", "ck1"), ("b", "ck2")):
        _end(land(spark, f"{tmp}/{src}", schema(CELL_AVAIL), lk, f"{tmp}/store", f"{tmp}/{ck}", enrich_kw=KW, sep="|"))
    assert read_store(spark, f"{tmp}/store").count() == 2
    assert spark.read.parquet(quarantine_of(f"{tmp}/store")).count() == 1


def test_families_land_by_their_own_schema(spark, tmp):
    lk = lookup_df(spark).where("VENDOR='Nokia'")
    other = [f for f in CELL_AVAIL if f["name"].upper() not in ("SAMPLES_CELL_AVAIL",)]
    _file(f"{tmp}/in", "A_NOKIA_LTE_20240105_100000000_TMO_lte_cell_avail.txt", ["2024-01-05 10:00", "2024-01-05 10:15"])
    write_delimited(f"{tmp}/in/A_NOKIA_LTE_20240105_100000000_TMO_lte_rrc.txt", [f["name"] for f in other],
                    [["r", "R", "M", "OSS1", "2024-01-05 10:00", 900, "DN1", "UID1", 2, 3, 4]], "|")
    write_delimited(f"{tmp}/in/A_NOKIA_LTE_20240105_100000000_TMO_lte_unknown.txt", ["x"], [["1"]], "|")
    registry = SchemaRegistry({"lte_cell_avail": schema(CELL_AVAIL), "lte_rrc": schema(other)})
    _end(land_families(spark, f"{tmp}/in", registry, lk, f"{tmp}/store", f"{tmp}/ck", enrich_kw=KW))
    counts = {r.pk_ft: r["count"] for r in read_store(spark, f"{tmp}/store").groupBy("pk_ft").count().collect()}
    assert counts == {"lte_cell_avail": 2, "lte_rrc": 1}
    assert spark.read.parquet(f"{quarantine_of(f'{tmp}/store')}/files").where("pk_ft = 'lte_unknown'").count() == 2


def test_measures_named_by_a_feature_file():
    text = "min(region) as Region, SUM(IFNULL(pmCellHoA, 0)) as pmHoA, max(pmB), avg( c ) AS c_mean, cell"
    found = typed_measures(text)
    assert found == [Measure("min", "region", "Region"), Measure("sum", "pmCellHoA", "pmHoA", "zero"), Measure("max", "pmB"),
                     Measure("avg", "c", "c_mean")]
    spec = KpiSpec("s", items=(Measure("min", "region", "Region"), Item("cell", "key", "cell"), CounterRule()), keys=("cell",))
    data = T.StructType([T.StructField(n, T.DoubleType()) for n in ("pmCellHoA", "pmB", "c", "not_named")])
    assert with_measures(spec, found).output_names(data) == ["Region", "cell", "pmHoA", "pmB", "c_mean"]


def test_counters_may_begin_like_keys(spark):
    df = spark.createDataFrame([("c", 1.0, 2.0, True, "f")], "cell string, hl_load double, pk_retx double, flag boolean, pk_ft string")
    spec = KpiSpec("s", items=(Item("cell", "key", "cell"), CounterRule()), keys=("cell",), identity=("cell",), hour_key="none")
    r = aggregate(df, spec, grain="rop", extra_keys=()).first()
    assert (r.hl_load, r.pk_retx, r.flag) == (1.0, 2.0, 1) and "pk_ft" not in r.asDict()


def test_quarter_hours_are_one_hour(spark):
    df = spark.sql("SELECT 'c' AS cell, timestamp('2024-01-05 10:00:00') + make_dt_interval(0, 0, 15 * id) AS hl_date, 1.0D AS a FROM range(5)")
    spec = KpiSpec("s", items=(Item("t", "time", "hl_date"), CounterRule()), keys=("cell",), time_keys=("hl_date",), identity=("cell",))
    rows = aggregate(df, spec, grain="hour", extra_keys=()).collect()
    assert sorted((str(r.t), r.a) for r in rows) == [("2024-01-05 10:00:00", 4.0), ("2024-01-05 11:00:00", 1.0)]


def test_formula_in_the_schema(spark):
    fields = [{"name": "cell", "type": "string", "agg": "cell"}, {"name": "rate", "type": "double", "agg": "sum(a) / sum(b)"},
              {"name": "a", "type": "double", "agg": "SUM"}]
    df = spark.createDataFrame([("x", 1.0, 2.0), ("x", 3.0, 2.0)], "cell string, a double, b double")
    r = aggregate_from_schema(df, schema_from_fields(fields)).first()
    assert (r.cell, r.rate, r.a) == ("x", 1.0, 4.0)


def test_text_counters_compare_as_numbers(spark):
    df = spark.createDataFrame([("c", "9", "x", "b"), ("c", "10", " 3 ", "a")], "cell string, m string, n string, name string")
    r = sql_feature_aggregate(df, "cell, max(m), avg(n) as n_mean, min(name) as label", "cell", extra_keys=()).first()
    assert (r.m, r.n_mean, r.label) == (10.0, 3.0, "a")


@pytest.mark.parametrize("n", [0, -1, 25])
def test_report_hours_are_1_to_24(spark, n):
    with pytest.raises(ValueError):
        latest_hours(spark.createDataFrame([], "pk_date string, pk_market string, pk_hr string"), n)


def test_rows_without_a_key_are_no_redeliveries(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), (None, 1, "c"), (None, 1, "d")], "k string, t int, v string")
    assert sorted(r.v for r in dedup_rows(df, ["k"], ["t"]).collect()) == ["b", "c", "d"]

"""Sources and store: delimited reads, routing, quarantine, store round trip, pruning."""

import os

from pyspark.sql import functions as F

from cellkpi.operators import select as sel
from cellkpi.plans.jobs import ingest
from cellkpi.sources.counters import (accept_known, family_of, known_families, quarantine_unknown,
                                      read_counters, read_counters_pipe, route_file_type)
from cellkpi.sources.lookup import build_lookup, lookup_scan
from cellkpi.sources.schema import (SchemaRegistry, all_string, spec_family_name, typed_from_strings,
                                    schema_file_name)
from cellkpi.sources.store import REFERENCE_LAYOUT, read_store, scan_partitions, write_store
from tests.fixtures import CELL_AVAIL, CELL_LOAD, lookup_df, schema, write_delimited, write_schema_dir

HDR = [f["name"] for f in CELL_AVAIL]


def _avail_rows(periods, market_oss="OSS1", uid="UID1"):
    return [["r", "R", "M", market_oss, p, 900, "DN1", uid, 1, 2, 3, 4] for p in periods]


def test_pipe_read_routing_and_quarantine(spark, tmp):
    d = os.path.join(tmp, "in")
    write_delimited(f"{d}/PM_NOKIA_LTE_20240105_101500000_TMO_lte_cell_avail.txt", HDR,
                    _avail_rows(["2024-01-05 10:00", "2024-01-05 10:15"]), "|")
    write_delimited(f"{d}/PM_NOKIA_LTE_20240105_101500000_TMO_lte_mystery_kpi.txt", HDR,
                    _avail_rows(["2024-01-05 10:00"]), "|")
    df = read_counters_pipe(spark, d, schema(CELL_AVAIL), with_source=True)
    routed = route_file_type(df)
    fams = sorted(r.pk_ft for r in routed.select("pk_ft").distinct().collect())
    assert fams == ["lte_cell_avail", "lte_mystery_kpi"]
    known = known_families(spark, ["lte_cell_avail", "lte_cell_load"])
    assert quarantine_unknown(routed, known).count() == 1
    assert accept_known(routed, known).count() == 2
    r = routed.where("pk_ft='lte_cell_avail'").orderBy("PERIOD_START_TIME").first()
    assert str(r.PERIOD_START_TIME) == "2024-01-05 10:00:00" and r.SAMPLES_CELL_AVAIL == 1.0


def test_family_name_rule(spark):
    df = spark.createDataFrame([("/x/y/A_NOKIA_LTE_20240101_000000000_TMO_lte_cell_avail.txt",),
                                ("short_name.txt",)], "p string")
    got = [r.f for r in df.select(family_of(F.col("p")).alias("f")).collect()]
    assert got == ["lte_cell_avail", ""]
    assert spec_family_name("lte_cell_avail") == "lte_nokia_cell_avail"
    assert schema_file_name("umts_traffic") == "umts_nokia_traffic_schema.json"


def test_registry_and_header_only_typing(spark, tmp):
    sd = write_schema_dir(os.path.join(tmp, "schemas"), {"lte_nokia_cell_avail": CELL_AVAIL,
                                                           "lte_nokia_cell_load": CELL_LOAD})
    reg = SchemaRegistry.from_dir(sd)
    assert reg.types() == ["lte_cell_avail", "lte_cell_load"]
    p = write_delimited(os.path.join(tmp, "c.csv"), ["cell", "c1", "c2"],
                        [["A", "9", " 7 "], ["B", "x", ""], ["C", "10", "1.5"]], ",")
    raw = read_counters(spark, p)                     # no schema: every column text
    assert dict(raw.dtypes)["c1"] == "string"
    typed = typed_from_strings(raw, identity=["cell"])
    got = {r.cell: (r.c1, r.c2) for r in typed.collect()}
    assert got == {"A": (9.0, 7.0), "B": (None, None), "C": (10.0, 1.5)}
    assert all(f.dataType.simpleString() == "string" for f in all_string(reg["lte_cell_load"]).fields)


def test_bad_period_goes_to_quarantine(spark, tmp):
    p = write_delimited(os.path.join(tmp, "in", "f.txt"), HDR,
                        _avail_rows(["2024-01-05 10:00", "not a time"]), "|")
    df = read_counters_pipe(spark, p, schema(CELL_AVAIL))
    lk = lookup_df(spark).where("VENDOR='Nokia'")
    store_p, q_p = os.path.join(tmp, "store"), os.path.join(tmp, "quarantine")
    ingest(df, lk, store_p, quarantine_path=q_p, oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID",
           attrs={"HL_Market": "MARKET"}, date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME",
           family="lte_cell_avail")
    assert read_store(spark, store_p).count() == 1
    assert spark.read.parquet(q_p).count() == 1
    assert not any("__HIVE_DEFAULT_PARTITION__" in d for d, _, _ in os.walk(store_p))


def test_store_roundtrip_layouts_and_pruning(spark, tmp):
    df = spark.createDataFrame(
        [("f1", "2024-01-05", "NEW YORK", "07", 1.0), ("f1", "2024-01-05", "NEW YORK", "08", 2.0),
         ("f1", "2024-01-06", "LONG_ISLAND/EAST", "00", 3.0), ("f2", "2024-01-06", "NEW YORK", "23", 4.0)],
        "pk_ft string, pk_date string, pk_market string, pk_hr string, v double")
    for layout in (None, REFERENCE_LAYOUT):
        p = os.path.join(tmp, f"store-{bool(layout)}")
        write_store(df, p, mode="overwrite", **({"partition_by": layout} if layout else {}))
        back = read_store(spark, p)
        assert sorted(map(tuple, back.select("pk_ft", "pk_date", "pk_market", "pk_hr", "v").collect())) == \
            sorted(map(tuple, df.collect()))
        s = scan_partitions(back, pk_date="2024-01-05", pk_market="NEW YORK", pk_hr=7)
        assert [r.v for r in s.collect()] == [1.0]
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "pk_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    idx = sel.ordered_index(back).collect()
    assert [(r.pk_ft, r.pk_market) for r in idx][:2] == [("f1", "LONG_ISLAND/EAST"), ("f1", "NEW YORK")]


def test_lookup_builder_and_pruned_scan(spark, tmp):
    p = build_lookup(lookup_df(spark), os.path.join(tmp, "lookup"))
    lk = lookup_scan(spark, p, "LTE", "Nokia")
    assert lk.count() == 4
    plan = lk._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "TECH" in plan
    assert os.path.isdir(os.path.join(p, "TECH=LTE", "VENDOR=Nokia"))

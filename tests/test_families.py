"""Family specs (E1-E4, N1-N16, M1-M12) on small fixtures in the source shapes."""

import pytest
from pyspark.sql import functions as F

from cellkpi.operators.enrich import derive_hl_date, derive_pk, enrich_for
from cellkpi.operators.spec import Item, KpiSpec, Measure, aggregate
from cellkpi.plans import families as fam
from cellkpi.sources.schema import text_counters_to_double, IDENTITY
from tests.fixtures import (CELL_AVAIL, CELL_LOAD, CELL_THROUGHPUT, ERIC_LTE, ERIC_UMTS, GSM_NB, SOFT_HO,
                            lookup_df, schema)


def _rows(spark, fields, rows):
    s = schema(fields)
    return spark.createDataFrame(rows, s)


def _ts(x):
    import datetime as dt
    return dt.datetime.fromisoformat(x)


def _nokia(spark, fields, rows, tech="lte"):
    df = _rows(spark, fields, rows)
    lk = lookup_df(spark).where(F.col("VENDOR") == "Nokia")
    e = enrich_for(df, lk, "nokia", tech)
    e = derive_hl_date(e).withColumn("hl_date", F.col("HL_Date"))
    return derive_pk(e, date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME").withColumn("pk_ft", F.lit("x"))


def test_all_specs_have_unique_names():
    specs = [s(["c"], hourly=h) for s in (fam.ericsson_lte, fam.ericsson_umts) for h in (False, True)]
    specs += [fam.nokia_lte(f) for f in fam.NOKIA_LTE_FAMILIES] + [fam.nokia_umts(f) for f in fam.NOKIA_UMTS_FAMILIES]
    assert len({s.name for s in specs}) == 4 + 16 + 12
    assert sum(s.derived for s in specs) == 12


def every_counter(df):
    """Counters of a test's rows: what is neither identity nor added by the pipeline."""
    known = {c.lower() for cols in IDENTITY.values() for c in cols} | {c.lower() for c in fam.ENRICHED}
    return [n for n, t in df.dtypes if t in ("double", "bigint") and n.lower() not in known]


def test_nokia_cell_avail_four_rops_one_hour(spark):
    p = ["2024-01-05 10:00:00", "2024-01-05 10:15:00", "2024-01-05 10:30:00", "2024-01-05 10:45:00"]
    rows = [("r", "R", "M", "oss1", _ts(t), 900.0, "DN1", "UID1", 1.0, None, 0.0, 2.0) for t in p]
    df = _nokia(spark, CELL_AVAIL, rows)
    spec = fam.nokia_lte("cell_avail")
    rop = aggregate(df, spec, grain="rop").collect()
    assert len(rop) == 4
    day = aggregate(df, spec, grain="day").collect()
    assert len(day) == 1
    d = day[0]
    assert d.SAMPLES_CELL_AVAIL == 4.0 and d.SAMPLES_CELL_PLAN_UNAVAIL is None   # NULL-propagating SUM
    assert d.period_duration == 3600.0 and d.cell == "UID1" and d.HL_Sectorlayer == ""
    assert str(d.PERIOD_START_TIME).startswith("2024-01-05 00:00")
    assert d.oss == "oss1" and d.HL_Market == "NEW YORK"
    cols = aggregate(df, spec, grain="rop").columns
    assert cols[:6] == ["MGR_RUN_ID", "oss", "PERIOD_START_TIME", "period_duration", "mo_dn", "cell"]


def test_nokia_cell_load_text_counters_max_avg(spark):
    vals = ["9", "10", " 7 ", "x", ""]
    rows = [("r", "R", "M", "OSS1", _ts("2024-01-05 10:00:00"), 900.0, "DN1", "UID1", 1.0, v, v, v, v) for v in vals]
    df = _nokia(spark, CELL_LOAD, rows)
    r = aggregate(df, fam.nokia_lte("cell_load"), grain="rop").first()
    assert r.rrc_conn_ue_max == 10.0           # numeric, not text ("9" > "10")
    assert r.rrc_conn_ue_avg == pytest.approx(26 / 3)
    assert r.rach_stp_att_small_msg == 5.0


def test_nokia_throughput_long_and_max(spark):
    rows = [("r", "R", "M", "OSS1", _ts("2024-01-05 10:00:00"), 900.0, "DN1", "UID1", 5, 1.5, 2.5, 1.0),
            ("r", "R", "M", "OSS1", _ts("2024-01-05 10:00:00"), 900.0, "DN1", "UID1", 7, 3.5, 0.5, 1.0)]
    df = _nokia(spark, CELL_THROUGHPUT, rows)
    r = aggregate(df, fam.nokia_lte("cell_throughput"), grain="rop").first()
    assert r.pdcp_sdu_vol_ul == 12 and r.pdcp_data_rate_max_ul == 3.5 and r.pdcp_data_rate_max_dl == 2.5


def test_nokia_neighbour_family_keyed_by_source(spark):
    rows = [("r", "R", "M", "OSS1", _ts("2024-01-05 10:00:00"), 900.0, "SRC", "UID1", 1.0, 1.0)]
    df = _nokia(spark, GSM_NB, rows)
    r = aggregate(df, fam.nokia_lte("isys_ho_gsm_nb_sum"), grain="rop").first()
    assert r.mo_dn == "SRC" and r.ISYS_HO_GERAN_SRVCC_ATT_NB == 1.0


def test_nokia_umts_derived(spark):
    rows = [("r", "R", "M", "OSS3", _ts("2024-01-05 10:00:00"), 900.0, "B", "L", "UID9", "C2", 1.0, None, "3"),
            ("r", "R", "M", "OSS3", _ts("2024-01-05 10:00:00"), 900.0, "B", "L", "UID9", "C2", 2.0, None, "x")]
    df = _nokia(spark, SOFT_HO, rows, tech="umts")
    r = aggregate(df, fam.nokia_umts("soft_handover"), grain="rop").first()
    assert r.cpich_ecno_class_0 == 3.0 and r.cpich_ecno_class_1 is None and r.cell_add_req_on_sho_for_rt == 3.0
    assert r.HL_Market == "NO SUFFIX"


def _eric_lte(spark):
    rows = [
        (_ts("2024-01-05 10:00:00"), "old", "R", "M", "SN", "ME1", "C1", _ts("2024-01-05 10:00:00"), 900.0, "oss1",
         1.0, None, 2.0, 3.0, 4.0, 1.0, None, 2.0),
        (_ts("2024-01-05 10:00:00"), "old", "R", "M", "SN", "ME1", "C1", _ts("2024-01-05 10:15:00"), None, "oss1",
         1.0, None, None, 3.0, 4.0, 1.0, None, 2.0),
    ]
    df = _rows(spark, ERIC_LTE, rows)
    e = enrich_for(df, lookup_df(spark).where("VENDOR='Ericsson' and TECH='LTE'"), "ericsson", "lte")
    e = e.withColumn("hl_date", F.col("HL_DATE"))
    return derive_pk(e, date_col="HL_DATE", hour_col="PERIOD_START_TIME")


def test_ericsson_lte_rop_names_and_null_policy(spark):
    df = _eric_lte(spark)
    out = aggregate(df, fam.ericsson_lte(every_counter(df)), grain="rop")
    cols = out.columns
    for c in ("pmHoPrepAtt_gcr", "pmRadioRecInterfernPwrPucch_0", "pmHoExeAttLteInterF",
              "period_duration_eutcfd19", "OSS", "HL_Sector", "HL_Site"):
        assert c in cols, c
    assert "pmCellHoExeAttLteInterF" not in cols
    assert len({c.lower() for c in cols}) == len(cols)
    rows = {str(r.PERIOD_START_TIME): r for r in out.collect()}
    r2 = rows["2024-01-05 10:15:00"]
    assert r2.pmRrcConnMax == 0.0 and r2.pmHoPrepAtt == 0.0 and r2.PERIOD_DURATION == 0.0   # IFNULL(x,0)
    assert r2.HL_Market == "NEW YORK" and r2.OSS == "oss1"


def test_ericsson_lte_hourly_and_daily(spark):
    df = _eric_lte(spark)
    h = aggregate(df, fam.ericsson_lte(every_counter(df), hourly=True), grain="hour").collect()
    assert len(h) == 1 and h[0].pmRrcConnEstabAtt == 2.0 and "OSS" not in h[0].asDict()
    assert "pmCellHoExeAttLteInterF" in h[0].asDict()          # the rename belongs to the other spec
    named = aggregate(df, fam.ericsson_lte(counters=["pmHoPrepAtt", "pmRrcConnMax"]), grain="rop").columns
    assert "pmHoPrepAtt" in named and "pmPdcchCceUtil_0" not in named
    d = aggregate(df, fam.ericsson_lte(every_counter(df)), grain="day").collect()
    assert len(d) == 1 and d[0].pmPdcchCceUtil_0 == 2.0


def test_ericsson_umts_rules(spark):
    rows = [(_ts("2024-01-05 10:00:00"), "old", "R", "M", "SN", "ME1", "U1234567890", _ts("2024-01-05 10:00:00"),
             None, "oss1", 1.0, 2.0),
            (_ts("2024-01-05 10:00:00"), "old", "R", "M", "SN", "ME1", "P9", _ts("2024-01-05 10:00:00"),
             900.0, "oss1", None, 2.0)]
    df = _rows(spark, ERIC_UMTS, rows)
    e = enrich_for(df, lookup_df(spark).where("VENDOR='Ericsson' and TECH='UMTS'"), "ericsson", "umts")
    e = derive_pk(e.withColumn("hl_date", F.col("HL_DATE")), date_col="HL_DATE", hour_col="PERIOD_START_TIME")
    rop = {r.utrancell: r for r in aggregate(e, fam.ericsson_umts(every_counter(e)), grain="rop").collect()}
    u = rop["U1234567890"]
    assert u.hl_umtssort == "U09" and u.HL_Sectorlayer == "AWS" and u.HL_Site == "SITE-U"
    assert u.pmNoRabEstablishAttempSpeech == 1.0 and u.PERIOD_DURATION is None    # plain SUM keeps NULL
    assert rop["P9"].HL_Sectorlayer == "PCS" and rop["P9"].HL_Market == "unassigned"
    hr = {r.utrancell: r for r in aggregate(e, fam.ericsson_umts(every_counter(e), hourly=True), grain="hour").collect()}
    assert hr["U1234567890"].HL_Site == "U12345678" and hr["P9"].HL_Cluster == "unassigned"


def test_identity_layouts_cover_vendors():
    assert set(IDENTITY) == {("ericsson", "lte"), ("ericsson", "umts"), ("nokia", "lte"), ("nokia", "umts")}


def test_label_codes_equal_the_plain_aggregate(spark):
    import datetime as dt
    from cellkpi.operators.spec import CounterRule
    from cellkpi.sources.labels import label_texts
    t = dt.datetime(2024, 1, 5, 10, 0)
    rows = [("c1", "oss1", "é", t, 1.0, 2.0), ("c1", "OSS0", "z", t, 3.0, None), (None, "oss2", None, t, 5.0, 1.0),
            (None, None, "", t, 7.0, 1.0), ("c2", None, None, None, 9.0, 4.0), ("", "x", "long label", t, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "cell string, oss string, region string, ts timestamp, a double, b double")
    spec = KpiSpec(name="t", items=(Item("cell", "key", "cell"), Measure("min", "oss", "oss"), Measure("min", "region", "area"),
                                    CounterRule(func="sum", null_policy="zero")),
                   keys=("cell",), time_keys=("ts",), identity=("cell", "oss", "ts", "region"))
    texts = label_texts(df, ["oss", "region"])
    one = aggregate(df, spec, grain="rop", extra_keys=())
    two = aggregate(df, spec, grain="rop", extra_keys=(), labels=texts)
    norm = lambda d: sorted(map(repr, d.select(*sorted(one.columns)).collect()))
    assert norm(one) == norm(two) and len(norm(two)) == 4        # NULL and empty cells stay apart
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    with pytest.raises(Exception, match="dictionary lacks"):
        aggregate(df, spec, grain="rop", extra_keys=(), labels=texts.where("text <> 'z'")).collect()


def test_every_counter_of_a_registered_schema_is_reported(spark):
    """Counter sets of all by-rule families: schema file = report, but for renames."""
    from cellkpi.plans import family_catalog as fc
    from cellkpi.operators.spec import parse_sql_features, typed_measures
    reg = fc.registry(spark)
    assert len(reg.types()) == 24
    for tech, families in fc.SCHEMA_COUNTERS.items():
        for family, n in families.items():
            spec = fam.nokia_lte(family) if tech == "lte" else fam.nokia_umts(family)
            schema_ = reg[f"{tech}_{family}"]
            counters = fc.counter_types(schema_, tech)
            assert len(counters) == n, family
            measures = [m for m in spec.measures(schema_) if m.source.lower() not in ("oss", "period_duration")]
            assert [m.source for m in measures] == list(counters), family
            assert sum(t == "string" for t in counters.values()) == fc.TEXT_COUNTERS.get((tech, family), 0)
    assert "fail_enb_ho_prep_ac_lien" in [m.name for m in fam.nokia_lte("inter_enb_ho").measures(reg["lte_inter_enb_ho"])]
    for feature, sums, maxima, labels in ((fc.older_lte_features(), 183, 3, 3), (fc.older_umts_features(), 48, 0, 4)):
        (select, _), = parse_sql_features(feature).values()
        found = typed_measures(select)
        assert [sum(m.func == f for m in found) for f in ("sum", "max", "min")] == [sums, maxima, labels]
        assert all(m.null_policy == "keep" for m in found)

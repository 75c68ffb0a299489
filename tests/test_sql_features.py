"""Specs kept as SQL text in the source system's feature-file format."""

import json
import os

from pyspark.sql import functions as F

from cellkpi.operators.spec import load_sql_features, sql_feature_aggregate
from cellkpi.plans.jobs import report_sql


def _store(spark):
    return spark.createDataFrame(
        [("f", "2024-01-05", "NY", "10", "2024-01-05 10:00:00", "c1", "oss1", 1.0, 900.0),
         ("f", "2024-01-05", "NY", "10", "2024-01-05 10:00:00", "c1", "oss1", None, 900.0),
         ("f", "2024-01-05", "NY", "11", "2024-01-05 11:00:00", "c1", "oss1", 4.0, None)],
        "pk_ft string, pk_date string, pk_market string, pk_hr string, hl_date string, cell string, "
        "oss string, pmA double, PERIOD_DURATION double")


def test_feature_file_pick_rules(tmp):
    p = os.path.join(tmp, "spec.json")
    json.dump({"features": [{"name": "x", "sql": [{"SELECT": "a", "GROUPBY": "g1"},
                                                   {"SELECT": "b", "GROUPBY": "g2"}, {"SELECT": "c"}]}]},
              open(p, "w"))
    assert load_sql_features(p)["x"] == ("a", "g1")
    assert load_sql_features(p, pick="last")["x"] == ("b", "g2")


def test_text_spec_set_at_a_time(spark):
    sel = ("'unassigned' as MGR_RUN_ID, min(oss) as oss, hl_date as PERIOD_START_TIME, cell, "
           "SUM(IFNULL(pmA,0)) as pmA, sum(PERIOD_DURATION) as PERIOD_DURATION, "
           "SUM(IFNULL(period_duration,0)) as period_duration")
    out = sql_feature_aggregate(_store(spark), sel, "hl_date, cell", run_id=F.lit("RID"))
    rows = {r.pk_hr: r for r in out.collect()}
    assert rows["10"].pmA == 1.0 and rows["11"].period_duration == 0.0 and rows["10"].MGR_RUN_ID == "RID"
    assert [c for c in out.columns if c.lower() == "period_duration"] == ["period_duration"]
    rep = report_sql(_store(spark), sel, "hl_date, cell", latest_n=1)
    assert [r.pk_hr for r in rep.collect()] == ["11"] and rep.first().MGR_RUN_ID.startswith("11-")

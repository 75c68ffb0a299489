"""What must not grow with the input: wide rows shuffled, cached batches, lookups sent through the driver, files of a stream."""

import os

import pytest
from pyspark.sql import functions as F

from cellkpi.operators.aggregate import deal_groups
from cellkpi.plans import catalog, ledger_catalog, vector_catalog
from cellkpi.plans import driver_tables as dt
from cellkpi.plans.jobs import enrich_with_pk
from tests.fixtures import lookup_df


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_groups_of_dealt_rows_need_no_exchange_of_wide_rows(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("a", 2, 5.0), (None, 1, 7.0), ("b", None, 11.0)], "cell string, hour int, v double")
    wide = lambda df: df.select("*", *[(F.col("v") * i).alias(f"w{i}") for i in range(1, 9)], F.lit("x").alias("label"))
    aggs = [F.min("label").alias("label"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(1, 9)]]
    got = wide(deal_groups(rows, ["cell", "hour"], order=["hour", "cell"])).groupBy("hour", "cell").agg(*aggs)
    plan = plan_of(got)
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, wide(rows).groupBy("hour", "cell").agg(*aggs).collect()))


def test_vector_store_keeps_no_batch_in_memory(spark, tmp, monkeypatch):
    asked = {}

    def write(df, path, **kw):
        asked.update(kw)
        raise InterruptedError

    monkeypatch.setattr(vector_catalog, "write_store", write)
    monkeypatch.setattr(vector_catalog, "vector_rows", lambda *a: None)
    with pytest.raises(InterruptedError):
        vector_catalog.vector_store_report(spark, tmp)
    assert asked["cache"] is False


def test_batches_take_their_part_of_rows_enriched_once(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "event_id long, cell string")
    once = ledger_catalog._written(rows.join(F.broadcast(rows.select("cell").withColumnRenamed("cell", "c")), F.col("cell") == F.col("c"), "left"))
    assert "Join" not in plan_of(once) and sorted(r.event_id for r in once.collect()) == [1, 2]


def test_lookup_beyond_the_bound_is_not_broadcast_by_a_batch(spark):
    rows = spark.createDataFrame([("oss1", "UID1", "2024-01-05 10:00"), (None, "UID1", "2024-01-05 10:00")], "OSS string, MO_DN2 string, t string")
    rows = rows.select("OSS", "MO_DN2", F.to_timestamp("t").alias("PERIOD_START_TIME"))
    kw = dict(oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID", attrs={"HL_Market": "MARKET"}, date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME")
    big, small = (enrich_with_pk(rows, lookup_df(spark), broadcast_rows=n, **kw) for n in (0, 50))
    assert "strategy=broadcast" not in big._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, big.collect())) == sorted(map(str, small.collect()))


@pytest.mark.parametrize("query, starter, folder", [("tumbling_hour_stream", "hourly.hourly_window_updates", "hourly-src"), ("landing_stream", "landing.land", "landing-src")])
def test_a_stream_gets_files_by_size(spark, tmp, monkeypatch, query, starter, folder):
    events = spark.range(200).selectExpr("id AS event_id", "timestamp'2024-01-05 10:00:00' AS ts", "id % 9 AS user_id",
                                         "if(id % 2 = 0, 'view', 'click') AS event_type", "cast(id AS double) AS value", "'' AS props")
    events.repartition(4).write.parquet(os.path.join(tmp, "events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))      # a task a file
    monkeypatch.setattr(dt, "cl", lambda *a: None)
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: os.path.join(tmp, name))

    def start(*a, **kw):
        raise InterruptedError

    monkeypatch.setattr(f"cellkpi.streaming.{starter}", start)
    try:
        with pytest.raises(InterruptedError):
            catalog.Q[query](spark, tmp)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    files = [f for d, _, names in os.walk(os.path.join(tmp, folder)) for f in names if f.startswith("part-")]
    assert len(files) == 2

"""Published batches: nothing half-written is seen, nothing is lost, compaction swaps in one step."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from cellkpi.sources import ledger
from cellkpi.sources.export import export_csv, hour_merge_order, read_export_in_order
from cellkpi.sources.store import read_store
from cellkpi.streaming.landing import write_batch


def batch(spark, n, day="2024-01-05", first=0):
    return spark.range(first, first + n).selectExpr(
        "cast(id AS string) AS cell", "cast(id AS double) AS v", f"to_timestamp('{day} 10:00:00') AS PERIOD_START_TIME", "'f' AS pk_ft",
        f"'{day}' AS pk_date", "'M' AS pk_market", "lpad(cast(id % 24 AS string), 2, '0') AS pk_hr")


def total(spark, path):
    return ledger.read_published(spark, path).count(), ledger.read_published_index(spark, path).agg(F.sum("n_rows")).first()[0]


def test_a_batch_killed_before_its_entry_is_not_seen_and_its_rerun_counts_once(spark, tmp, monkeypatch):
    path = f"{tmp}/s"
    assert ledger.write_batch_published(batch(spark, 30), path, "b1")
    with monkeypatch.context() as m:
        def killed(*a, **k):
            raise RuntimeError("killed between store and index")
        m.setattr("cellkpi.streaming.landing.write_index", killed)
        with pytest.raises(RuntimeError, match="killed"):
            ledger.write_batch_published(batch(spark, 10, "2024-01-06"), path, "b2")
    assert read_store(spark, path).count() == 40 and total(spark, path) == (30, 30)
    assert ledger.write_batch_published(batch(spark, 10, "2024-01-06"), path, "b2")
    assert total(spark, path) == (40, 40)
    assert not ledger.publish(path, "b2", ledger.published_units(spark, path, "b2"))          # once only
    assert total(spark, path) == (40, 40)


def test_compaction_bounds_files_and_keeps_rows(spark, tmp):
    path = f"{tmp}/s"
    for i in range(4):
        ledger.write_batch_published(batch(spark, 5, first=5 * i), path, f"b{i}")
    ledger.write_batch_published(batch(spark, 3, "2024-01-07"), path, "other")
    rows = sorted(map(tuple, ledger.read_published(spark, path).select("cell", "v", "pk_date", "pk_hr").collect()))
    assert ledger.compact(spark, path, "c1") == 4
    assert rows == sorted(map(tuple, ledger.read_published(spark, path).select("cell", "v", "pk_date", "pk_hr").collect()))
    assert total(spark, path) == (23, 23)
    units = {tuple(r) for r in ledger.visible(spark, path).collect()}
    assert units == {("f", "2024-01-05", "c1"), ("f", "2024-01-07", "other")}
    assert len(glob.glob(f"{path}/pk_ft=f/pk_date=2024-01-05/pk_batch=c1/*.parquet")) == 1
    assert ledger.compact(spark, path, "c2") == 0


def test_records_delivered_again_count_once(spark, tmp):
    path = f"{tmp}/s"
    ledger.write_batch_published(batch(spark, 20), path, "b1", delivered_keys=["cell", "PERIOD_START_TIME"])
    again = batch(spark, 30).unionByName(batch(spark, 1).withColumn("cell", F.lit(None).cast("string")))
    ledger.write_batch_published(again, path, "b2", delivered_keys=["cell", "PERIOD_START_TIME"])
    ledger.write_batch_published(batch(spark, 4, "2024-01-09"), path, "b3", delivered_keys=["cell", "PERIOD_START_TIME"])
    assert total(spark, path) == (35, 35)


def test_an_unpublished_store_is_empty(spark, tmp):
    write_batch(batch(spark, 3), f"{tmp}/s", "b1")
    assert ledger.read_published(spark, f"{tmp}/s").count() == 0 and ledger.visible(spark, f"{tmp}/s").count() == 0


def test_a_key_split_over_tasks_reads_newest_hour_first_over_its_parts(spark, tmp):
    df = batch(spark, 20_000).select("pk_date", "pk_market", "pk_ft", "pk_hr", "cell")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")            # else so few rows are one part
    try:
        export_csv(df, f"{tmp}/out", keys=("pk_date", "pk_market", "pk_ft"), order=hour_merge_order())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    files = sorted(glob.glob(f"{tmp}/out/*/*/*/part-*"), key=os.path.basename)
    assert len(files) == 4
    hours = [line.split(",")[0] for f in files for line in open(f).read().splitlines()[1:]]
    assert len(hours) == 20_000 and hours == sorted(hours, reverse=True)
    back = read_export_in_order(spark, f"{tmp}/out").orderBy("part", "line").select("pk_hr").collect()
    assert [r.pk_hr for r in back] == hours

"""Newest hours from a bounded state: the rows of the ranked index, without ranking it."""

import pytest
from pyspark.sql import functions as F

from cellkpi.operators.select import latest_hours
from cellkpi.sources import ledger
from cellkpi.sources.newest import newest_hours, read_newest, refresh_newest
from cellkpi.sources.store import index_path, read_store


def batch(spark, first, n, days, market="M"):
    day = f"date_format(date_add(DATE'2023-11-25', cast((id * 7) % {days} AS int)), 'yyyy-MM-dd')"
    return spark.range(first, first + n).selectExpr(
        "cast(id AS double) AS v", "to_timestamp('2024-01-05 10:00:00') AS PERIOD_START_TIME",
        "concat('f', id % 2) AS pk_ft", f"{day} AS pk_date", f"concat('{market}', id % 3) AS pk_market",
        "lpad(cast((id * 5) % 24 AS string), 2, '0') AS pk_hr")


def rows(df):
    return {tuple(r) for r in df.select("pk_ft", "pk_date", "pk_market", "pk_hr", "hour_rank").collect()}


def ranked(spark, path, n=24):
    return rows(latest_hours(ledger.read_published_index(spark, path), n))


@pytest.mark.parametrize("n", [1, 3, 24])
def test_aggregates_give_the_rows_of_the_ranking(spark, n):
    index = batch(spark, 0, 5000, 500)
    assert rows(newest_hours(index, n)) == rows(latest_hours(index, n))
    plan = newest_hours(index, n)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_bounds_empty_and_incomplete_keys(spark):
    index = batch(spark, 0, 50, 5)
    for n in (0, 25):
        with pytest.raises(ValueError):
            newest_hours(index, n)
    assert rows(newest_hours(index.where("false"))) == set()
    holes = index.unionByName(index.withColumn("pk_hr", F.lit(None).cast("string")))
    assert rows(newest_hours(holes)) == rows(latest_hours(index, 24))


def test_state_follows_later_late_and_compacted_batches(spark, tmp):
    path = f"{tmp}/s"
    ledger.write_batch_published(batch(spark, 0, 600, 9), path, "b0")
    assert rows(read_newest(spark, path)) == ranked(spark, path)           # no state yet
    refresh_newest(spark, path)
    ledger.write_batch_published(batch(spark, 9000, 60, 14), path, "b1")   # newer days, and late rows of old ones
    ledger.write_batch_published(batch(spark, 100, 9, 3, "New"), path, "b2")
    assert rows(read_newest(spark, path)) == ranked(spark, path)           # not refreshed since
    refresh_newest(spark, path)
    ledger.compact(spark, path, "c0")
    assert rows(read_newest(spark, path)) == ranked(spark, path)
    refresh_newest(spark, path)
    assert rows(read_newest(spark, path)) == ranked(spark, path)


def test_a_batch_not_published_adds_no_hour(spark, tmp):
    from cellkpi.streaming.landing import write_batch
    path = f"{tmp}/s"
    ledger.write_batch_published(batch(spark, 0, 300, 4), path, "b0")
    refresh_newest(spark, path)
    write_batch(batch(spark, 0, 100, 12), path, "killed")
    assert rows(read_newest(spark, path)) == ranked(spark, path)


def test_an_hour_taken_away_folds_the_index_again(spark, tmp):
    path = f"{tmp}/s"
    ledger.write_batch_published(batch(spark, 0, 200, 6), path, "b0")
    ledger.write_batch_published(batch(spark, 0, 200, 9), path, "newer")
    refresh_newest(spark, path)
    units = ledger.published_units(spark, path, "newer")
    ledger.publish(path, "withdrawn", units.where("false"), units)
    assert rows(read_newest(spark, path)) == ranked(spark, path)
    refresh_newest(spark, path)
    assert rows(read_newest(spark, path)) == ranked(spark, path)


def test_only_the_index_rows_of_later_entries_are_read(spark, tmp):
    path = f"{tmp}/s"
    ledger.write_batch_published(batch(spark, 0, 200, 8), path, "b0")
    refresh_newest(spark, path)
    ledger.write_batch_published(batch(spark, 0, 1, 1), path, "b1")
    days = read_store(spark, index_path(path)).select("pk_ft", "pk_date").distinct().count()
    newest = read_newest(spark, path)
    newest.collect()
    read, nodes = [], [newest._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif "FileSourceScan" in node.getClass().getSimpleName() and node.metrics().contains("numPartitions"):
            read.append(node.metrics().apply("numPartitions").value())
        kids = node.children()
        nodes += [kids.apply(i) for i in range(kids.size())]
    assert read and max(read) <= 2 < days                                   # the touched family-day in its two batches

"""Mergeable states: exact against a full recomputation, and only touched days are recomputed."""

import glob
import os

from pyspark.sql import functions as F

from cellkpi.plans import rollups
from cellkpi.sources import ledger


def batch(spark, first, n, day):
    return spark.range(first, first + n).selectExpr(
        "cast(id % 3 AS string) AS cell", "IF(id % 5 = 0, NULL, cast(id AS double)) AS v",
        f"to_timestamp('{day} 10:00:00') AS PERIOD_START_TIME", "'f' AS pk_ft", f"'{day}' AS pk_date",
        "concat('M', id % 2) AS pk_market", "lpad(cast(id % 24 AS string), 2, '0') AS pk_hr")


def recomputed(spark, path, keys):
    return {tuple(r) for r in ledger.read_published(spark, path).groupBy(*keys, "cell").agg(
        F.count("*"), F.sum("v"), F.avg("v"), F.max("v"), F.min("v")).collect()}


def rolled(spark, path, states, grain, keys):
    return {tuple(r) for r in rollups.read_rollup(spark, path, states, grain).select(
        *keys, "cell", "n_rows", *rollups.finals("v")).collect()}


def check(spark, path, states):
    for grain, keys in (("hour", rollups.HOUR_KEYS), ("day", rollups.DAY_KEYS)):
        assert rolled(spark, path, states, grain, keys) == recomputed(spark, path, keys)


def files(states):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{states}/*/*/*/*/*.parquet")}


def test_only_touched_days_are_recomputed_and_averages_stay_exact(spark, tmp):
    path, states = f"{tmp}/s", f"{tmp}/r"
    for i, day in enumerate(("2024-01-05", "2024-01-06", "2024-01-07")):
        ledger.write_batch_published(batch(spark, 100 * i, 60, day), path, f"b{i}")
    assert rollups.refresh(spark, path, states, ["cell"], ["v"]) == 3
    check(spark, path, states)
    before = files(states)
    assert rollups.refresh(spark, path, states, ["cell"], ["v"]) == 0 and files(states) == before
    ledger.write_batch_published(batch(spark, 1000, 7, "2024-01-06"), path, "late")          # 7 rows beside 60: a mean of means is off
    # not refreshed yet: the changed day is not served from its old states
    assert {r.pk_date for r in rollups.read_rollup(spark, path, states, "day").select("pk_date").distinct().collect()} == {"2024-01-05", "2024-01-07"}
    assert [r.pk_date for r in rollups.stale_days(spark, path, states).collect()] == ["2024-01-06"]
    assert rollups.refresh(spark, path, states, ["cell"], ["v"]) == 1
    after = files(states)
    assert before.items() <= after.items()                       # no file of another day was written again
    assert all("pk_date=2024-01-06" in f for f in set(after) - set(before))
    check(spark, path, states)
    assert rollups.remove_old_states(spark, path, states) == 2   # the old hour and day states of that day
    check(spark, path, states)


def test_a_refresh_killed_between_hours_and_days_is_not_served_and_is_redone(spark, tmp, monkeypatch):
    path, states = f"{tmp}/s", f"{tmp}/r"
    ledger.write_batch_published(batch(spark, 0, 40, "2024-01-05"), path, "b0")
    rollups.refresh(spark, path, states, ["cell"], ["v"])
    ledger.write_batch_published(batch(spark, 0, 40, "2024-01-06"), path, "b1")
    with monkeypatch.context() as m:
        m.setattr(rollups, "merge_states", lambda *a: 1 / 0)
        try:
            rollups.refresh(spark, path, states, ["cell"], ["v"])
        except ZeroDivisionError:
            pass
    assert {r.pk_date for r in rollups.read_rollup(spark, path, states, "hour").select("pk_date").collect()} == {"2024-01-05"}
    assert rollups.refresh(spark, path, states, ["cell"], ["v"]) == 1
    check(spark, path, states)


def test_compaction_and_an_empty_counter(spark, tmp):
    path, states = f"{tmp}/s", f"{tmp}/r"
    for i in range(3):
        ledger.write_batch_published(batch(spark, 10 * i, 9, "2024-01-05").withColumn("v", F.lit(None).cast("double")), path, f"b{i}")
    rollups.refresh(spark, path, states, ["cell"], ["v"])
    check(spark, path, states)
    ledger.compact(spark, path, "c")
    assert rollups.refresh(spark, path, states, ["cell"], ["v"]) == 1        # its batches are others now
    check(spark, path, states)

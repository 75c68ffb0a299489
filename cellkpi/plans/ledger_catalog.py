"""Catalogue entries for a store that is read through its ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellkpi.plans.catalog import BASE, IDX_SQL, LATEST_N, LATEST_SQL, ekc, finish, q
from cellkpi.session import scratch_path
from cellkpi.sources import ledger
from cellkpi.sources.newest import read_newest, refresh_newest
from cellkpi.streaming.landing import write_batch


def _written(rows):
    """``rows`` written once and read back: every batch below takes its part of them, and would
    otherwise send the whole lookup through the driver again for each of its reads."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "ledger-rows")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@q("ledger_batches", BASE.rstrip("\n") + """
SELECT pk_ft, pk_date, pk_market, count(*) AS n_rows, count(*) AS n_indexed, round(sum(value), 4) AS value, 1::BIGINT AS n_batches
FROM ekc GROUP BY pk_ft, pk_date, pk_market""")
def ledger_batches(spark, sf):
    """Three batches of the records, the second delivered again with part of the
    first; one more batch was written but never published; then all family-days are
    compacted. What readers see is every record once."""
    path, rows = scratch_path(spark, "ledger-store"), _written(ekc(spark, sf))
    for name, part in (("b0", "event_id % 3 = 0"), ("b1", "event_id % 3 = 1"), ("b1-again", "event_id % 3 = 1 OR event_id % 6 = 0"), ("b2", "event_id % 3 = 2")):
        ledger.write_batch_published(rows.where(part), path, name, delivered_keys=["event_id"])
    write_batch(rows.where("event_id % 5 = 0"), path, "killed")
    ledger.compact(spark, path, "compacted")
    keys = ["pk_ft", "pk_date", "pk_market"]
    seen = ledger.read_published(spark, path).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value"),
                                                                 F.count_distinct("pk_batch").alias("n_batches"))
    listed = ledger.read_published_index(spark, path).groupBy(*keys).agg(F.sum("n_rows").alias("n_indexed"))
    return finish(seen.join(listed, keys, "full"))


@q("newest_hours_kept", BASE.rstrip("\n") + ",\n" + IDX_SQL + ",\n" + LATEST_SQL + """
SELECT pk_ft, pk_date, pk_market, pk_hr, hour_rank FROM lat""")
def newest_hours_kept(spark, sf):
    """The newest hours of each market from the state kept beside the ledger: refreshed after the
    first batch, then read with a batch of newer and late records and one of none beside it."""
    path, rows = scratch_path(spark, "newest-store"), _written(ekc(spark, sf))
    first = (F.dayofmonth("HL_DATE") < 20) & (F.col("event_id") % 4 != 1)
    ledger.write_batch_published(rows.where(first), path, "first")
    refresh_newest(spark, path)
    ledger.write_batch_published(rows.where(~first), path, "second")
    ledger.write_batch_published(rows.where("false"), path, "empty")
    return read_newest(spark, path).where(F.col("hour_rank") <= LATEST_N)

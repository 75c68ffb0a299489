"""Incremental landing (R1) and hourly windows with late data (R2)."""

import os
import shutil

from pyspark.sql import functions as F

from cellkpi.sources.store import read_index, read_store
from cellkpi.streaming.hourly import hourly_window_agg, hourly_window_stream
from cellkpi.streaming.landing import land
from tests.fixtures import CELL_AVAIL, lookup_df, schema, write_delimited

HDR = [f["name"] for f in CELL_AVAIL]
KW = dict(oss_col="OSS", cell_col="MO_DN2", lookup_cell_col="CELL_UID", attrs={"HL_Market": "MARKET"},
          date_col="PERIOD_START_TIME", hour_col="PERIOD_START_TIME")


def _file(d, name, periods):
    rows = [["r", "R", "M", "OSS1", p, 900, "DN1", "UID1", 1, 2, 3, 4] for p in periods]
    return write_delimited(os.path.join(d, name), HDR, rows, "|")


def test_landing_exactly_once_and_batch_equivalence(spark, tmp):
    src, store, ck = (os.path.join(tmp, x) for x in ("landing", "store", "ck"))
    lk = lookup_df(spark).where("VENDOR='Nokia'")
    f1 = _file(src, "A_NOKIA_LTE_20240105_100000000_TMO_lte_cell_avail.txt", ["2024-01-05 10:00", "2024-01-05 10:15"])

    def run():
        q = land(spark, src, schema(CELL_AVAIL), lk, store, ck, enrich_kw=KW, sep="|")
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    assert read_store(spark, store).count() == 2
    # the same file delivered again (same path): not read twice
    shutil.copy(f1, f1 + ".tmp"); os.replace(f1 + ".tmp", f1)
    _file(src, "A_NOKIA_LTE_20240105_110000000_TMO_lte_cell_avail.txt", ["2024-01-05 11:00"])
    run()
    st = read_store(spark, store)
    assert st.count() == 3
    assert {r.pk_ft for r in st.select("pk_ft").distinct().collect()} == {"lte_cell_avail"}
    assert st.where("HL_Market = 'NEW YORK'").count() == 3
    # the partition index written batch by batch matches the store
    idx = {(r.pk_ft, r.pk_date, r.pk_market, r.pk_hr): r.n_rows for r in read_index(spark, store).collect()}
    assert idx == {("lte_cell_avail", "2024-01-05", "NEW YORK", "10"): 2,
                   ("lte_cell_avail", "2024-01-05", "NEW YORK", "11"): 1}
    # repair and compaction keep the stream's batch-keyed index layout readable
    from cellkpi.sources.store import compact_index, rebuild_index
    rebuild_index(spark, store)
    compact_index(spark, store)
    assert {(r.pk_ft, r.pk_date, r.pk_market, r.pk_hr): r.n_rows for r in read_index(spark, store).collect()} == idx
    run()                                                # the stream continues on the rebuilt index
    assert read_store(spark, store).count() == 3


def test_hourly_window_batch_and_stream_agree(spark, tmp):
    rows = [("c1", "2024-01-05 10:00:00", 1.0), ("c1", "2024-01-05 10:45:00", 2.0),
            ("c1", "2024-01-05 11:15:00", 4.0), ("c2", "2024-01-05 10:30:00", 8.0)]
    df = spark.createDataFrame(rows, "cell string, t string, value double") \
        .select("cell", F.to_timestamp("t").alias("PERIOD_START_TIME"), "value")
    batch = {(str(r.window_start), r.cell): r.value for r in hourly_window_agg(df).collect()}
    assert batch[("2024-01-05 10:00:00", "c1")] == 3.0
    p = os.path.join(tmp, "src")
    df.write.parquet(p)
    s = spark.readStream.schema(df.schema).parquet(p)
    got = {}

    def sink(b, _):
        for r in b.collect():
            got[(str(r.window_start), r.cell)] = r.value

    q = (hourly_window_stream(s).writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert got == batch


def test_window_log_updates_late_hours_and_drops_too_late(spark, tmp):
    import time
    from cellkpi.streaming.hourly import hourly_window_updates, read_current_windows
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    sch = "cell string, t string, value double"

    def put(name, rows):
        p = os.path.join(tmp, "stage-" + name)
        spark.createDataFrame(rows, sch).select("cell", F.to_timestamp("t").alias("PERIOD_START_TIME"), "value") \
            .coalesce(1).write.parquet(p)
        f = [x for x in os.listdir(p) if x.endswith(".parquet")][0]
        os.replace(os.path.join(p, f), os.path.join(src, name + ".parquet"))
        time.sleep(1.1)                                  # distinct modification times: arrival order

    # Spark filters late rows of a micro-batch with the watermark of the batch before, so lateness
    # shows from the third arrival on: a -> watermark 11:15; b (11:45 is late, within the hour)
    # updates 11:00; c (09:30, behind the watermark) is dropped.
    put("a", [("c1", "2024-01-05 11:15:00", 1.0), ("c1", "2024-01-05 12:15:00", 2.0)])
    put("b", [("c1", "2024-01-05 11:45:00", 4.0), ("c1", "2024-01-05 13:15:00", 16.0)])
    put("c", [("c1", "2024-01-05 09:30:00", 8.0)])
    stream = spark.readStream.schema("cell string, PERIOD_START_TIME timestamp, value double") \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(tmp, "log")
    q = hourly_window_updates(stream, out, os.path.join(tmp, "ck"), lateness="1 hour")
    q.awaitTermination(120)
    assert q.exception() is None
    cur = {str(r.window_start): (r.value, r.n_rows) for r in read_current_windows(spark, out).collect()}
    assert cur == {"2024-01-05 11:00:00": (5.0, 2), "2024-01-05 12:00:00": (2.0, 1),
                   "2024-01-05 13:00:00": (16.0, 1)}
    assert spark.read.parquet(out).select("_batch").distinct().count() >= 2
    # compaction keeps the current state and drops superseded versions
    from cellkpi.streaming.hourly import compact_window_log
    before = spark.read.parquet(out).count()
    compact_window_log(spark, out)
    assert {str(r.window_start): (r.value, r.n_rows) for r in read_current_windows(spark, out).collect()} == cur
    assert spark.read.parquet(out).count() == 3 < before

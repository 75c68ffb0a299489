"""Hourly tumbling-window aggregate, batch and streaming forms."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _aggs(value_col: str):
    return [F.sum(value_col).alias(value_col), F.count(F.lit(1)).alias("n_rows")]


def hourly_window_agg(df: DataFrame, *, time_col: str = "PERIOD_START_TIME",
                      keys: Sequence[str] = ("cell",), value_col: str = "value") -> DataFrame:
    """Batch: ROP rows summed into 1-hour tumbling windows per key."""
    g = df.groupBy(F.window(time_col, "1 hour").alias("w"), *keys).agg(*_aggs(value_col))
    return g.select(F.col("w.start").alias("window_start"), *keys, value_col, "n_rows")


def hourly_window_stream(df: DataFrame, *, time_col: str = "PERIOD_START_TIME",
                         keys: Sequence[str] = ("cell",), value_col: str = "value",
                         lateness: str = "2 hours") -> DataFrame:
    """Streaming: same aggregate with a watermark; rows later than
    ``lateness`` behind the newest period are dropped, state is bounded."""
    g = (df.withWatermark(time_col, lateness)
           .groupBy(F.window(time_col, "1 hour").alias("w"), *keys).agg(*_aggs(value_col)))
    return g.select(F.col("w.start").alias("window_start"), *keys, value_col, "n_rows")


def hourly_window_updates(stream: DataFrame, out_path: str, checkpoint: str, *,
                          time_col: str = "PERIOD_START_TIME", keys: Sequence[str] = ("cell",),
                          value_col: str = "value", lateness: str = "2 hours", available_now: bool = True):
    """Run the watermarked hourly aggregate in update mode into a window log.

    Each micro-batch writes the windows it changed into its own ``_stream`` (the
    query's id, kept in its checkpoint) and ``_batch`` partition (dynamic
    overwrite: a retried batch replaces its rows, another stream's batches stay).
    Late rows within ``lateness`` update their hour in a later batch; the current
    value of every window is the row of its newest batch
    (:func:`read_current_windows`). State is bounded by the watermark.
    """
    from cellkpi.streaming.landing import start_keyed

    agg = hourly_window_stream(stream, time_col=time_col, keys=keys, value_col=value_col, lateness=lateness)

    def _batch(df: DataFrame, key: str) -> None:
        stream_id, _, number = key.rpartition("-")
        (df.withColumns({"_at": F.current_timestamp(), "_stream": F.lit(stream_id), "_batch": F.lit(int(number))})
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_stream", "_batch").parquet(out_path))

    return start_keyed(agg, _batch, checkpoint, available_now, output_mode="update")


def _newest_versions(spark, out_path: str, keys: Sequence[str]) -> DataFrame:
    from cellkpi.operators.enrich import dedup_rows

    log = spark.read.parquet(out_path)
    return dedup_rows(log, ["window_start", *keys], ["_at", "_batch"], keep="last")


def read_current_windows(spark, out_path: str, keys: Sequence[str] = ("cell",)) -> DataFrame:
    """Current hourly values: per (window, keys) the row of the newest batch
    (a partial/final aggregate, see ``operators.enrich.dedup_rows``)."""
    return _newest_versions(spark, out_path, keys).drop("_at", "_stream", "_batch")


def compact_window_log(spark, out_path: str, keys: Sequence[str] = ("cell",)) -> str:
    """Rewrite the log as its current state (one version per window, each
    keeping the batch id it came from), so it stops growing with every
    micro-batch. The current state is first checkpointed (reliable, under
    ``spark.checkpoint.dir``), then added to the log as a stream of its own, and
    only then are the partitions that it stands for emptied: a crash in between
    leaves rows twice, never none. Run it while the stream is stopped."""
    from cellkpi.session import checkpoint_root

    checkpoint_root(spark)
    old = [r[0] for r in spark.read.parquet(out_path).select("_stream").distinct().collect()]
    cur = _newest_versions(spark, out_path, keys).checkpoint(eager=True)
    cur.withColumns({"_stream": F.lit(f"compacted-{uuid.uuid4().hex[:12]}")}).write.mode("append") \
        .partitionBy("_stream", "_batch").parquet(out_path)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(out_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for stream_id in old:
        fs.delete(fs_path(f"{out_path}/_stream={stream_id}"), True)
    return out_path


# -- rows later than the lateness: counted in the hour they belong to, and listed

DELTAS, LATE, NEWEST = "deltas", "late", "newest"


def hourly_window_reopened(stream: DataFrame, out_path: str, checkpoint: str, *,
                           time_col: str = "PERIOD_START_TIME", keys: Sequence[str] = ("cell",),
                           value_col: str = "value", lateness: str = "2 hours", available_now: bool = True):
    """Hourly sums in which a row counts however late it comes.

    The watermarked form forgets an hour once the watermark has passed it and drops what
    comes later. Here a micro-batch writes what it *adds* to each hour (``deltas``), and the
    current value of an hour is the sum of its deltas: there is no state to hold or to forget,
    so an old hour is opened again by writing one more row. Rows whose hour ended at or before
    the newest period of the earlier batches less ``lateness`` are late by the watermark's rule;
    they are marked in the deltas and written whole to ``late`` for those who must
    re-issue a report. Rows without a period have no hour: they go to ``late`` alone.

    Everything is keyed by query and batch (dynamic overwrite) and the newest period is taken from the
    batches before, so a repeated batch replaces its own rows with the same ones.
    """
    from cellkpi.streaming.landing import start_keyed

    def _batch(df: DataFrame, key: str) -> None:
        spark = df.sparkSession
        stream_id, _, number = key.rpartition("-")
        own = {"_stream": F.lit(stream_id), "_batch": F.lit(int(number))}
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = _read(spark, f"{out_path}/{NEWEST}", "newest timestamp, _stream string, _batch int")
            newest = seen.where((F.col("_stream") == stream_id) & (F.col("_batch") < int(number))).agg(F.unix_micros(F.max("newest"))).first()[0]
            end = F.window(time_col, "1 hour")["end"]
            limit = F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {lateness}")
            late = F.coalesce(end <= limit, F.lit(False))
            placed = df.where(F.col(time_col).isNotNull()).withColumn("_late", late)
            deltas = (placed.groupBy(F.window(time_col, "1 hour").alias("w"), *keys)
                      .agg(*_aggs(value_col), F.count_if("_late").alias("n_late"))
                      .select(F.col("w.start").alias("window_start"), *keys, value_col, "n_rows", "n_late"))
            _write(deltas.withColumns(own), f"{out_path}/{DELTAS}")
            listed = placed.where("_late").drop("_late").withColumn("_reason", F.lit("late"))
            lost = df.where(F.col(time_col).isNull()).withColumn("_reason", F.lit("no period"))
            _write(listed.unionByName(lost).withColumns(own), f"{out_path}/{LATE}")
            _write(df.agg(F.max(time_col).alias("newest")).withColumns(own), f"{out_path}/{NEWEST}")
        finally:
            df.unpersist()

    return start_keyed(stream, _batch, checkpoint, available_now)


def _write(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_stream", "_batch").parquet(path))


def _read(spark, path: str, schema: str | None = None) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def read_reopened_windows(spark, out_path: str, keys: Sequence[str] = ("cell",), value_col: str = "value") -> DataFrame:
    """Current hourly values with ``n_late``, the number of their rows that came late: one
    partial/final aggregate over the deltas."""
    log = spark.read.parquet(f"{out_path}/{DELTAS}")
    return log.groupBy("window_start", *keys).agg(F.sum(value_col).alias(value_col), F.sum("n_rows").alias("n_rows"),
                                                  F.sum("n_late").alias("n_late"))


def read_late_rows(spark, out_path: str) -> DataFrame:
    """The rows that came late or without a period, with their reason and batch."""
    return spark.read.parquet(f"{out_path}/{LATE}")

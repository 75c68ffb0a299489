"""Incremental landing: new counter files -> enriched store, exactly once.

Replaces polling a landing folder and moving files: the file source's
checkpoint records every file already processed (a re-delivered file with
the same path is never read again), and each micro-batch writes its own
``pk_batch`` partitions with dynamic overwrite, so a retried batch replaces
its earlier partial output instead of appending a second copy. ``pk_batch``
holds the query's id, which its checkpoint keeps, and the batch number: a
second stream, or a new checkpoint that counts from 0 again, never replaces
what another one landed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import threading

from cellkpi.plans.jobs import enrich_with_pk, quarantine_of
from cellkpi.sources.counters import (ERICSSON_SEP, NOKIA_SEP, PERIOD_TS_FORMAT, route_file_type,
                                      split_bad_periods)
from cellkpi.sources.schema import SchemaRegistry
from cellkpi.sources.store import CLUSTER_BY, write_index

STREAM_LAYOUT = ("pk_ft", "pk_date", "pk_batch")

# A broadcast lookup goes through the driver once a micro-batch, not once a job, so
# only a lookup of a few MB is; a larger one is joined by shuffle.
STREAM_BROADCAST_ROWS = 50_000


def counter_stream(spark: SparkSession, source_dir: str, schema: T.StructType, *,
                   sep: str = ERICSSON_SEP, ts_format: str = PERIOD_TS_FORMAT,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of delimited counter files with their source path."""
    r = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
         .option("timestampFormat", ts_format).option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(source_dir).withColumn("_source_file", F.col("_metadata.file_path"))


def write_batch(df: DataFrame, store_path: str, batch_id: int | str, quarantine_path: str | None = None) -> None:
    """Idempotent batch write: dynamic overwrite of this batch's partitions
    (store and partition index alike, both keyed by ``pk_batch``). Files are
    clustered and bounded like those of a batch ingest; rows without a place in
    the store go to the quarantine (default: a hidden folder of the store)."""
    df = df.withColumn("pk_batch", F.lit(batch_id)).persist(StorageLevel.MEMORY_AND_DISK)
    try:                                  # one read of the batch for store, index and quarantine
        good, bad = split_bad_periods(df)
        (good.hint("rebalance", "pk_ft", "pk_date").sortWithinPartitions("pk_ft", "pk_date", *CLUSTER_BY)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", "zstd").option("maxRecordsPerFile", 5_000_000)
             .partitionBy(*STREAM_LAYOUT).parquet(store_path))
        write_index(good, store_path, mode="overwrite", partition_by=STREAM_LAYOUT, overwrite_mode="dynamic")
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("pk_batch").parquet(quarantine_path or quarantine_of(store_path)))
    finally:
        df.unpersist()


def land(spark: SparkSession, source_dir: str, schema: T.StructType, lookup: DataFrame, store_path: str,
         checkpoint: str, *, enrich_kw: dict, sep: str = ERICSSON_SEP, family: str | None = None,
         family_from: str = "name", quarantine_path: str | None = None, available_now: bool = True,
         max_files_per_trigger: int | None = None,
         transform: Callable[[DataFrame], DataFrame] | None = None):
    """Start the landing query (``availableNow``: process what is there, then stop).

    ``family``: fixed family for a single-family folder. Otherwise
    ``family_from='name'`` takes it from each file's name (the delivery
    naming rule), ``'column'`` keeps the ``pk_ft`` column of the input
    (e.g. a ``pk_ft=<family>`` folder level listed in ``schema``).
    """
    stream = counter_stream(spark, source_dir, schema, sep=sep, max_files_per_trigger=max_files_per_trigger)
    if family is not None:
        stream = stream.withColumn("pk_ft", F.lit(family))
    elif family_from == "name":
        stream = route_file_type(stream, "_source_file")
    elif family_from != "column":
        raise ValueError("family_from must be 'name' or 'column'")
    if transform is not None:
        stream = transform(stream)

    def _batch(df: DataFrame, key: str) -> None:
        enriched = enrich_with_pk(df.drop("_source_file"), lookup, **{"broadcast_rows": STREAM_BROADCAST_ROWS, **enrich_kw})
        write_batch(enriched, store_path, key, quarantine_path)

    return start_keyed(stream, _batch, checkpoint, available_now)


def start_keyed(stream: DataFrame, work: Callable[[DataFrame, str], None], checkpoint: str, available_now: bool = True,
                output_mode: str = "append"):
    """Start ``work`` on every micro-batch with its key '<query id>-<batch>'. The
    query id is kept in the checkpoint, so a retried batch has the same key."""
    started, query_id = threading.Event(), []

    def _batch(df: DataFrame, batch_id: int) -> None:
        started.wait()
        work(df, f"{query_id[0]}-{batch_id}")

    w = stream.writeStream.outputMode(output_mode).foreachBatch(_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query = w.start()
    query_id.append(str(query.id))
    started.set()
    return query


def parse_lines(lines: DataFrame, schema: T.StructType, *, sep: str, ts_format: str = PERIOD_TS_FORMAT) -> DataFrame:
    """Delimited ``value`` lines as typed columns of ``schema`` (by position,
    tolerant); header lines (first field = first column's name) fall away."""
    first = F.trim(F.element_at(F.split("value", f"[{sep}]"), 1))
    options = {"sep": sep, "timestampFormat": ts_format, "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (lines.where(F.lower(first) != schema.fields[0].name.lower())
            .select(F.from_csv("value", ddl, options).alias("r"), "pk_ft").select("r.*", "pk_ft"))


def land_families(spark: SparkSession, source_dir: str, registry: SchemaRegistry, lookup: DataFrame, store_path: str,
                  checkpoint: str, *, enrich_kw: dict, sep: str = NOKIA_SEP, quarantine_path: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None):
    """Land files of many families from one folder: a file's family comes from its
    name, its columns from that family's registered schema. Lines of files whose
    family is not registered go to the quarantine as they are, with their path.
    A micro-batch writes one family after the other (at most the registry's)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = route_file_type(r.load(source_dir).withColumn("_source_file", F.col("_metadata.file_path")), "_source_file")
    types = registry.types()

    def _batch(lines: DataFrame, key: str) -> None:
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            present = [x.pk_ft for x in lines.where(F.col("pk_ft").isin(types)).select("pk_ft").distinct().collect()]
            for family in sorted(present):
                rows = parse_lines(lines.where(F.col("pk_ft") == family), registry[family], sep=sep)
                write_batch(enrich_with_pk(rows, lookup, **{"broadcast_rows": STREAM_BROADCAST_ROWS, **enrich_kw}), store_path, key,
                            f"{quarantine_path or quarantine_of(store_path)}/rows/{family}")
            (lines.where(~F.col("pk_ft").isin(types) | F.col("pk_ft").isNull()).withColumn("pk_batch", F.lit(key))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("pk_batch").parquet(f"{quarantine_path or quarantine_of(store_path)}/files"))
        finally:
            lines.unpersist()

    return start_keyed(stream, _batch, checkpoint, available_now)

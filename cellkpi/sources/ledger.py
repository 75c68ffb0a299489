"""Batch ledger: what readers of a store may see.

Store, index and quarantine are three writes. A batch keeps each of them in
partitions of its own (``pk_batch``) and becomes visible by one atomic rename of its
entry into ``<store>/_ledger``; a job killed before that leaves nothing that a
reader sees, and its rerun overwrites what it left. An entry lists partitions
``(pk_ft, pk_date, pk_batch)`` that it adds and others that it drops, so compaction swaps
many small batches of a family-day for one in the same single step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.operators.joins import small_side
from cellkpi.session import scratch_path
from cellkpi.sources.store import CLUSTER_BY, PK, index_path, read_store

LEDGER_DIR = "_ledger"
UNIT = ("pk_ft", "pk_date", "pk_batch")
_ENTRY = "action string, pk_ft string, pk_date string, pk_batch string"


def ledger_path(store_path: str) -> str:
    return f"{store_path.rstrip('/')}/{LEDGER_DIR}"


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(store_path: str, entry: str, added: DataFrame, dropped: DataFrame | None = None) -> bool:
    """Make the partitions ``added`` visible (and ``dropped`` invisible) under the name
    ``entry``. An entry is published once: False if it already was."""
    spark = added.sparkSession
    rows = added.select(F.lit("add").alias("action"), *UNIT)
    if dropped is not None:
        rows = rows.unionByName(dropped.select(F.lit("drop").alias("action"), *UNIT))
    stage = scratch_path(spark, "ledger-entry")
    rows.distinct().coalesce(1).write.json(stage)                # a row a family-day of the batch
    folder, fs = _folder(spark, ledger_path(store_path))
    fs.mkdirs(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = path(f"{ledger_path(store_path)}/{entry}.json")
    if fs.exists(target):
        return False
    parts = [s.getPath() for s in fs.listStatus(path(stage)) if s.getPath().getName().startswith("part-")]
    if not parts:                                                # a batch without rows
        return fs.createNewFile(target)
    return fs.rename(parts[0], target)


def read_log(spark: SparkSession, store_path: str) -> DataFrame:
    """All lines of the ledger with the name of their entry; one listing of its files,
    so whatever is derived from one result belongs to one state of the store."""
    folder, fs = _folder(spark, ledger_path(store_path))
    if not fs.exists(folder):
        return spark.createDataFrame([], T._parse_datatype_string(f"entry string, {_ENTRY}"))
    log = spark.read.schema(_ENTRY).json(ledger_path(store_path))
    return log.select(F.col("_metadata.file_name").alias("entry"), "action", *UNIT)


def live_units(log: DataFrame) -> DataFrame:
    """Partitions of a ledger's lines that are published and not replaced."""
    gone = log.where("action = 'drop'").select(*UNIT)
    return log.where("action = 'add'").select(*UNIT).distinct().join(gone, list(UNIT), "left_anti")


def visible(spark: SparkSession, store_path: str) -> DataFrame:
    """Partitions (pk_ft, pk_date, pk_batch) that are published and not replaced."""
    return live_units(read_log(spark, store_path))


def only_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Rows of some partitions; the list is written and read back, so that the scan
    is pruned at run time (see ``operators.select.restrict_to``)."""
    spark = df.sparkSession
    path = scratch_path(spark, "visible")
    units.withColumn("_sel", F.lit(1)).write.parquet(path)
    return df.join(small_side(spark.read.parquet(path).where("_sel = 1").select(*UNIT)), list(UNIT), "left_semi")


def read_published(spark: SparkSession, store_path: str, schema: T.StructType | None = None) -> DataFrame:
    """The store as its ledger states it."""
    return only_units(read_store(spark, store_path, schema), visible(spark, store_path))


def read_published_index(spark: SparkSession, store_path: str) -> DataFrame:
    """The partition index of the published batches: one row per (family, date, market, hour)."""
    rows = only_units(read_store(spark, index_path(store_path)), visible(spark, store_path))
    return rows.groupBy(*PK).agg(F.sum("n_rows").alias("n_rows"))


def published_units(spark: SparkSession, store_path: str, batch: str) -> DataFrame:
    """Partitions that a batch has written (from its index rows)."""
    return read_store(spark, index_path(store_path)).where(F.col("pk_batch") == batch).select(*UNIT).distinct()


def drop_delivered(rows: DataFrame, store_path: str, keys: Sequence[str]) -> DataFrame:
    """``rows`` (with partition keys) without records that a published batch holds
    already. Only the key columns of the family-days that ``rows`` touch are read; a record
    with a null in its key is never a re-delivery."""
    spark = rows.sparkSession
    days = rows.select("pk_ft", "pk_date").distinct()
    units = visible(spark, store_path).join(days, ["pk_ft", "pk_date"], "left_semi")
    if units.isEmpty():
        return rows
    match = list(dict.fromkeys(["pk_ft", "pk_date", *keys]))
    held = only_units(read_store(spark, store_path), units).select(*match)
    return rows.join(held, match, "left_anti")


def write_batch_published(rows: DataFrame, store_path: str, batch: str, *, delivered_keys: Sequence[str] = (),
                          quarantine_path: str | None = None) -> bool:
    """One batch into store, index and quarantine, then into the ledger. With
    ``delivered_keys`` records of earlier batches are left out."""
    from cellkpi.streaming.landing import write_batch
    if delivered_keys:
        rows = drop_delivered(rows, store_path, delivered_keys)
    write_batch(rows, store_path, batch, quarantine_path)
    return publish(store_path, batch, published_units(rows.sparkSession, store_path, batch))


def compact(spark: SparkSession, store_path: str, name: str, *, least_batches: int = 2, since: str | None = None) -> int:
    """Rewrite each family-day that has at least ``least_batches`` published batches as one
    batch ``name``: its rows go into as few files as AQE's advisory size allows, and
    one ledger entry swaps them. Returns the number of partitions replaced.
    A killed run leaves only invisible files; rerun it under its name."""
    live = visible(spark, store_path)
    if since is not None:
        live = live.where(F.col("pk_date") >= since)
    days = live.groupBy("pk_ft", "pk_date").agg(F.count("*").alias("n")).where(F.col("n") >= least_batches).drop("n")
    path = scratch_path(spark, "compacted")
    live.join(days, ["pk_ft", "pk_date"], "left_semi").write.parquet(path)
    old = spark.read.parquet(path)
    replaced = old.count()
    if not replaced:
        return 0
    rows = only_units(read_store(spark, store_path), old).withColumn("pk_batch", F.lit(name))
    (rows.hint("rebalance", "pk_ft", "pk_date").sortWithinPartitions("pk_ft", "pk_date", *CLUSTER_BY)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*UNIT).parquet(store_path))
    counts = only_units(read_store(spark, index_path(store_path)), old).withColumn("pk_batch", F.lit(name))
    (counts.groupBy(*PK, "pk_batch").agg(F.sum("n_rows").alias("n_rows")).repartition(*UNIT)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*UNIT).parquet(index_path(store_path)))
    publish(store_path, name, old.select("pk_ft", "pk_date").distinct().withColumn("pk_batch", F.lit(name)), old)
    return replaced

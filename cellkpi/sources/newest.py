"""Newest hours of every market as a bounded state beside a store's ledger.

A report needs the newest hours of each (family, market), at most 24, whatever the
length of the store's history. The newest hours of a union are among the newest of its
parts, so the state keeps 24 hours a (family, market) and the names of the
ledger entries that it has taken in; a reader adds the index rows of the family-days
of later entries, and ranks nothing else.

Entries that replace partitions (compaction) keep their hours. If one of them took
an hour of the state away, the state is not used and the whole index is folded again.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.session import scratch_path
from cellkpi.sources import ledger
from cellkpi.sources.store import PK, index_path, read_store

NEWEST_DIR = "_newest"
KEEP = 24                       # a report takes 1 to 24 hours
_PER = ("pk_ft", "pk_market")


def newest_hours(index: DataFrame, n: int = KEEP) -> DataFrame:
    """The newest ``n`` (1 to 24) hours of every (family, market) with their rank, as
    ``operators.select.latest_hours`` gives them, by aggregates alone.

    Hours are folded by month, year and market. A group holds at most the 744 hours of a month,
    ``n`` hours of 12 months or ``n`` hours of each year, and repeated keys collapse
    in each task before an exchange. Rows without a date, a market or an hour are in no hour.
    """
    if not 1 <= n <= KEEP:
        raise ValueError("a report takes 1 to 24 hours")
    hour = F.struct("pk_date", "pk_hr")
    rows = index.select(*PK).where(F.col("pk_date").isNotNull() & F.col("pk_market").isNotNull() & F.col("pk_hr").isNotNull())
    best = rows.groupBy(*_PER, F.substring("pk_date", 1, 7).alias("span")).agg(F.collect_set(hour).alias("hours"))
    best = best.withColumn("hours", F.slice(F.sort_array("hours", asc=False), 1, n))
    for width in (4, 0):
        best = best.groupBy(*_PER, F.expr(f"left(span, {width})").alias("span")).agg(F.flatten(F.collect_list("hours")).alias("hours"))
        best = best.withColumn("hours", F.slice(F.sort_array("hours", asc=False), 1, n))
    ranked = best.select(*_PER, F.posexplode("hours").alias("at", "hour"))
    return ranked.select("pk_ft", F.col("hour.pk_date").alias("pk_date"), "pk_market", F.col("hour.pk_hr").alias("pk_hr"),
                         (F.col("at") + 1).cast("int").alias("hour_rank"))


def _folder(store_path: str) -> str:
    return f"{store_path.rstrip('/')}/{NEWEST_DIR}"


def _versions(spark: SparkSession, store_path: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(store_path))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _index_of(spark: SparkSession, store_path: str, units: DataFrame) -> DataFrame:
    return ledger.only_units(read_store(spark, index_path(store_path)), units).select(*PK)


def _fold(spark: SparkSession, store_path: str, log: DataFrame) -> DataFrame:
    """Newest hours as the ledger's lines ``log`` state them."""
    live, versions = ledger.live_units(log), _versions(spark, store_path)
    if not versions:
        return newest_hours(_index_of(spark, store_path, live))
    version = f"{_folder(store_path)}/{versions[-1]}"
    state = spark.read.parquet(f"{version}/hours")
    later = log.join(spark.read.parquet(f"{version}/entries"), "entry", "left_anti")
    days = later.select("pk_ft", "pk_date").distinct()
    if days.isEmpty():
        return state
    touched = _index_of(spark, store_path, live.join(days, ["pk_ft", "pk_date"], "left_semi"))
    same = reduce(lambda a, b: a & b, [state[c].eqNullSafe(touched[c]) for c in PK])
    lost = state.join(days, ["pk_ft", "pk_date"], "left_semi").join(touched, same, "left_anti")
    if not lost.isEmpty():
        return newest_hours(_index_of(spark, store_path, live))
    return newest_hours(state.select(*PK).unionByName(touched))


def refresh_newest(spark: SparkSession, store_path: str) -> str:
    """Take all present entries of the ledger into the state. A version is written
    whole and shown by one rename; each names its own entries, so that of two
    refreshers at a time either may come last, and a killed one leaves nothing."""
    log = ledger.read_log(spark, store_path)
    stage = scratch_path(spark, "newest")
    _fold(spark, store_path, log).coalesce(1).write.parquet(f"{stage}/hours")     # 24 rows a family and market
    log.select("entry").distinct().write.parquet(f"{stage}/entries")
    versions = _versions(spark, store_path)
    number = int(versions[-1].split("-")[0]) + 1 if versions else 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = path(f"{_folder(store_path)}/{number:09d}-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if not fs.rename(path(stage), target):
        raise OSError(f"could not publish {target}")
    return target.toString()


def read_newest(spark: SparkSession, store_path: str) -> DataFrame:
    """The newest 24 hours of every (family, market) as the ledger shows them now, refreshed
    or not. ``report(index=...)`` takes it in place of the whole partition index."""
    return _fold(spark, store_path, ledger.read_log(spark, store_path))

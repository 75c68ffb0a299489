"""Roll-ups kept as mergeable states, recomputed only where the store changed.

A state row holds the sum, count, maximum and minimum of each counter for one key of an
hour or a day; states merge by adding and comparing, so days come from hours and an
average stays exact (sum over count, never a mean of means).

The states of a family-day lie in a partition of their own, named after the set of
published batches that they were computed from (``sources.ledger``). Readers join the
ledger's present sets with these names: a family-day whose batches changed since is
not served from old states, a killed refresh leaves nothing that a reader takes for
complete, and running it again overwrites what it left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.operators.joins import small_side
from cellkpi.session import scratch_path
from cellkpi.sources import ledger
from cellkpi.sources.store import read_store

DAY = ("pk_ft", "pk_date")
HOUR_KEYS = ("pk_ft", "pk_date", "pk_market", "pk_hr")
DAY_KEYS = ("pk_ft", "pk_date", "pk_market")
PARTS = ("sum", "count", "max", "min")
_LAYOUT = ("pk_ft", "pk_date", "pk_state")


def hour_states(rows: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """One state a key and hour. A null counter adds nothing; a key whose counter is
    null everywhere has count 0 and null sum, maximum and minimum."""
    made = [f(c).alias(f"{c}__{p}") for c in counters for p, f in zip(PARTS, (F.sum, F.count, F.max, F.min), strict=True)]
    return rows.groupBy(*HOUR_KEYS, *keys).agg(F.count(F.lit(1)).alias("n_rows"), *made)


def merge_states(states: DataFrame, by: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """States of a coarser grain: any states whose rows do not overlap may be merged."""
    how = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
    made = [how[p](f"{c}__{p}").alias(f"{c}__{p}") for c in counters for p in PARTS]
    return states.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *made)


def finals(counter: str) -> list[Column]:
    """Sum, average, maximum and minimum of a state as report columns."""
    n = F.col(f"{counter}__count")
    return [F.col(f"{counter}__sum").alias(f"{counter}_sum"),
            F.when(n > 0, F.col(f"{counter}__sum") / n).alias(f"{counter}_avg"),
            F.col(f"{counter}__max").alias(f"{counter}_max"), F.col(f"{counter}__min").alias(f"{counter}_min")]


def day_versions(spark: SparkSession, store_path: str) -> DataFrame:
    """(pk_ft, pk_date, pk_state): the present set of batches of each family-day as a name.
    The list of a family-day is as long as its published batches, which compaction bounds."""
    return ledger.visible(spark, store_path).groupBy(*DAY).agg(
        F.md5(F.to_json(F.array_sort(F.collect_set("pk_batch")))).alias("pk_state"))


def _states(spark: SparkSession, rollup_path: str, grain: str) -> DataFrame | None:
    path = f"{rollup_path.rstrip('/')}/{grain}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return read_store(spark, path)


def stale_days(spark: SparkSession, store_path: str, rollup_path: str) -> DataFrame:
    """Family-days (with their present version) that have no day state yet. Only names of
    partitions are read."""
    now = day_versions(spark, store_path)
    have = _states(spark, rollup_path, "day")
    return now if have is None else now.join(have.select(*_LAYOUT).distinct(), list(_LAYOUT), "left_anti")


def _written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """A small list as a file with a marker filter, so that scans are pruned by it at run time."""
    path = scratch_path(spark, name)
    rows.withColumn("_sel", F.lit(1)).write.parquet(path)
    return spark.read.parquet(path).where("_sel = 1").drop("_sel")


def _write(states: DataFrame, path: str) -> None:
    (states.hint("rebalance", *_LAYOUT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .option("compression", "zstd").partitionBy(*_LAYOUT).parquet(path))


def refresh(spark: SparkSession, store_path: str, rollup_path: str, keys: Sequence[str], counters: Sequence[str]) -> int:
    """Bring hour and day states up to the ledger; returns the number of family-days
    recomputed. The others' counters and states are not read. Days are merged from the hour
    states just written and are written last, so a day state stands only beside whole
    hour states."""
    todo = _written(spark, stale_days(spark, store_path, rollup_path), "stale-days")
    n = todo.count()
    if not n:
        return 0
    units = ledger.visible(spark, store_path).join(todo.select(*DAY), list(DAY), "left_semi")
    rows = ledger.only_units(read_store(spark, store_path), units)
    root = rollup_path.rstrip("/")
    _write(hour_states(rows, keys, counters).join(small_side(todo), list(DAY)), f"{root}/hour")
    hours = read_store(spark, f"{root}/hour").join(small_side(todo), list(_LAYOUT), "left_semi")
    _write(merge_states(hours, [*DAY_KEYS, "pk_state", *keys], counters), f"{root}/day")
    return n


def read_rollup(spark: SparkSession, store_path: str, rollup_path: str, grain: str) -> DataFrame:
    """States of ``grain`` ('hour' or 'day') of the family-days whose states are those of
    the ledger's present batches; :func:`stale_days` lists the others."""
    have = _states(spark, rollup_path, grain)
    if have is None:
        raise FileNotFoundError(f"no {grain} states in {rollup_path}: run refresh first")
    live = day_versions(spark, store_path)
    complete = _states(spark, rollup_path, "day")
    if grain != "day" and complete is not None:
        live = live.join(complete.select(*_LAYOUT).distinct(), list(_LAYOUT), "left_semi")
    return have.join(small_side(_written(spark, live, "day-versions")), list(_LAYOUT), "left_semi").drop("pk_state")


def remove_old_states(spark: SparkSession, store_path: str, rollup_path: str) -> int:
    """Delete partitions of states that no reader takes any more (run it while no
    reader that started before the last refresh is at work)."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = 0
    for grain in ("hour", "day"):
        have = _states(spark, rollup_path, grain)
        if have is None:
            continue
        old = have.select(*_LAYOUT).distinct().join(day_versions(spark, store_path), list(_LAYOUT), "left_anti")
        for r in old.toLocalIterator():                          # names of partitions, one by one
            target = path(f"{rollup_path.rstrip('/')}/{grain}/pk_ft={r.pk_ft}/pk_date={r.pk_date}/pk_state={r.pk_state}")
            gone += bool(target.getFileSystem(conf).delete(target, True))
    return gone

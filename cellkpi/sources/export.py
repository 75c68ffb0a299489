"""Report sinks: CSV per export key (one file per key, newest hour first)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CSV_DATE_FORMAT = "yyyy-MM-dd"
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def export_csv(df: DataFrame, path: str, *, keys: Sequence[str] = ("export_key",),
               order: Sequence = (), mode: str = "overwrite") -> str:
    """Write CSV reports (with header), a folder per export key.

    Without ``order``, ``REBALANCE`` on the key puts each key's rows in one task
    (one file per key, the report format) while AQE splits an oversized key over
    several tasks. With ``order`` (e.g. newest hour first) rows are exchanged by ranges
    of (key, order): tasks, and with them the numbered part files, follow that
    order, so a key that is split over several files still reads in order from part
    to part. A hash of the row ends the range key, so that even one hour
    with a third of all rows can be split. Keys without rows produce no directory, so
    empty reports need no count. An overwrite replaces the whole export: keys of an
    earlier run do not stay.
    """
    keys = list(keys)
    if order:
        spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        out = df.repartitionByRange(*keys, *order, spread).sortWithinPartitions(*keys, *order)
    else:
        out = df.hint("rebalance", *keys)
    (out.write.mode(mode).option("header", True).option("partitionOverwriteMode", "static")
        .option("dateFormat", CSV_DATE_FORMAT).option("timestampFormat", CSV_TS_FORMAT)
        .partitionBy(*keys).csv(path))
    return path


def read_export_in_order(spark, path: str) -> DataFrame:
    """An export read back with the place of each row: ``part`` (file name; the
    numbered parts of a key follow each other) and ``line`` (its order inside the part)."""
    back = (spark.read.option("header", True).option("inferSchema", False).option("basePath", path).csv(path))
    return back.select("*", F.col("_metadata.file_name").alias("part"),
                       (F.col("_metadata.file_block_start") * (1 << 20) + F.monotonically_increasing_id() % (1 << 33)).alias("line"))


def read_export(spark, path: str) -> DataFrame:
    """Read an export back (all keys), keeping every column as text."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("basePath", path).csv(path))


def hour_merge_order():
    """Order inside a (date, market[, family]) file: newest hour first."""
    return [F.col("pk_hr").desc()]

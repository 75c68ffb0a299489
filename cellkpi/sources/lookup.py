"""Cell lookup: builder (partitioned parquet) and pruned scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOOKUP_PARTITIONS = ("TECH", "VENDOR", "MARKET")


def build_lookup(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write the lookup partitioned by TECH/VENDOR/MARKET (one file per partition).
    An overwrite replaces the whole lookup whatever the session's overwrite
    mode is: a cell that moved must not stay in its old market."""
    (df.repartition(*LOOKUP_PARTITIONS).write.mode(mode).option("partitionOverwriteMode", "static")
       .partitionBy(*LOOKUP_PARTITIONS).parquet(path))
    return path


def lookup_scan(spark: SparkSession, path: str, tech: str, vendor: str) -> DataFrame:
    """Only the TECH=/VENDOR= sub-directories are listed and read (partition pruning)."""
    return spark.read.parquet(path).where((F.col("TECH") == tech) & (F.col("VENDOR") == vendor))

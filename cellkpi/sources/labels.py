"""Label dictionary: text labels as ordered codes.

``MIN(label)`` over text has no fixed-width buffer, so one text label makes
Spark run a whole aggregate by sorting. With a code for each label, in
the order of the texts, the minimum is a number and the aggregate stays a hash
aggregate. The dictionary stands beside the store (as the partition index does);
every batch appends the distinct labels it brings, so it holds at least the
labels of the store and never needs to be rewritten when partitions are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.operators.joins import is_small
from cellkpi.session import scratch_path

LABELS_DIR = "_labels"


def labels_path(store_path: str) -> str:
    return f"{store_path.rstrip('/')}/{LABELS_DIR}"


def label_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct texts of the label columns (one hash aggregate over these columns only)."""
    texts = F.explode(F.array_distinct(F.array(*[F.col(f"`{c}`").cast("string") for c in columns])))
    return df.select(texts.alias("text")).where("text IS NOT NULL").distinct()


def write_labels(rows: DataFrame, store_path: str, columns: Sequence[str]) -> str:
    label_texts(rows, columns).coalesce(1).write.mode("append").parquet(labels_path(store_path))
    return labels_path(store_path)


def read_labels(spark: SparkSession, store_path: str) -> DataFrame:
    """Distinct label texts of a store."""
    return spark.read.parquet(labels_path(store_path)).select("text").distinct()


class LabelCodes:
    """Codes of label texts, written once (codes of a recomputed sort could
    differ). ``usable`` is False beyond the broadcast bound."""

    def __init__(self, texts: DataFrame):
        spark, path = texts.sparkSession, scratch_path(texts.sparkSession, "label-codes")
        ordered = texts.where("text IS NOT NULL").select("text").distinct().orderBy("text")
        ordered.select("text", F.monotonically_increasing_id().alias("code")).write.parquet(path)
        self.table = spark.read.schema("text string, code long").parquet(path)
        self.usable = is_small(self.table)

    def encode(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` plus the code of a label column; a text that the dictionary does
        not hold is an error, never a lost label."""
        t = F.broadcast(self.table.select(F.col("text").alias("__text"), F.col("code").alias("__code")))
        label = F.col(f"`{column}`")
        lost = F.raise_error(F.concat(F.lit(f"{column}: a label that the dictionary lacks: "), label))
        code = F.when(F.col("__code").isNotNull() | label.isNull(), F.col("__code")).otherwise(lost.cast("long"))
        return df.join(t, label == F.col("__text"), "left").withColumn(out, code).drop("__text", "__code")

    def decode(self, df: DataFrame, column: str) -> DataFrame:
        """Codes of ``column`` as texts again."""
        t = F.broadcast(self.table.select(F.col("text").alias("__text"), F.col("code").alias("__code")))
        return (df.join(t, F.col(f"`{column}`") == F.col("__code"), "left")
                .withColumn(column, F.col("__text")).drop("__text", "__code"))

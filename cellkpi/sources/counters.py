"""Delimited counter files: reading, family routing, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the delivery format.
PERIOD_TS_FORMAT = "yyyy-MM-dd HH:mm"
ERICSSON_SEP = ","
NOKIA_SEP = "|"
FAMILY_TOKEN_START = 6          # family = '_'-tokens 6.. of the file's base name
FAMILY_FROM_NAME = r"^(?:[^_]*_){6}(.+?)(?:\.[^._]*)?$"


def read_counters(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, *,
                  sep: str = ERICSSON_SEP, ts_format: str = PERIOD_TS_FORMAT,
                  with_source: bool = False) -> DataFrame:
    """Read delimited counter files (header row, both-side trim).

    With ``schema`` columns bind by position and are typed; a value that does
    not parse becomes NULL (PERMISSIVE). Without it every column is text
    (header names) — type it with ``typed_from_strings``. All paths are one
    scan: Spark splits the files into tasks, no manual batching.
    """
    r = (spark.read.option("header", True).option("sep", sep)
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
         .option("timestampFormat", ts_format).option("mode", "PERMISSIVE"))
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(list(paths) if not isinstance(paths, str) else paths)
    if with_source:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def read_counters_pipe(spark: SparkSession, paths, schema=None, **kw) -> DataFrame:
    return read_counters(spark, paths, schema, sep=NOKIA_SEP, **kw)


def file_base_name(path_col: Column) -> Column:
    return F.element_at(F.split(path_col, "/"), -1)


def family_of(name_col: Column) -> Column:
    """Counter family from a delivery file name: tokens 6.. of the '_'-split
    base name, extension removed; '' when the name has too few tokens."""
    return F.regexp_extract(file_base_name(name_col), FAMILY_FROM_NAME, 1)


def route_file_type(df: DataFrame, name_col: Column | str = "_source_file") -> DataFrame:
    """Add ``pk_ft`` (family) derived from each row's source file name."""
    col = F.col(name_col) if isinstance(name_col, str) else name_col
    return df.withColumn("pk_ft", family_of(col))


def known_families(spark: SparkSession, types: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in types], "pk_ft string")


def quarantine_unknown(df: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose family has no registered schema (left anti join).

    ``known`` has one row per registered schema file, so broadcasting it is
    bounded by the registry, not by the data.
    """
    return df.join(F.broadcast(known.select("pk_ft").distinct()), "pk_ft", "left_anti")


def accept_known(df: DataFrame, known: DataFrame) -> DataFrame:
    return df.join(F.broadcast(known.select("pk_ft").distinct()), "pk_ft", "left_semi")


def is_bad_row(df: DataFrame, period_col: str = "PERIOD_START_TIME",
               types: Sequence[str] | None = None) -> Column:
    """True for a row that has no place in the store: a NULL/unparseable
    period start or stamp (it would land in __HIVE_DEFAULT_PARTITION__), a
    missing partition key, an empty family or, with ``types``, a family
    without a registered schema."""
    bad = F.col(period_col).isNull()
    for c in ("pk_date", "pk_hr", "pk_market", "pk_ft"):
        if c in df.columns:
            bad = bad | F.col(c).isNull() | (F.col(c) == "")
    if types is not None:
        bad = bad | ~F.col("pk_ft").isin(list(types))
    return F.coalesce(bad, F.lit(True))


def split_bad_periods(df: DataFrame, period_col: str = "PERIOD_START_TIME",
                      types: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) by :func:`is_bad_row`; together they are all rows."""
    bad = is_bad_row(df, period_col, types)
    return df.where(~bad), df.where(bad)

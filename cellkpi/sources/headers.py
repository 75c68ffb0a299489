"""Delivery files whose columns are bound by the names in their own headers.

A read with one schema binds by position, so a file with another column order (a new
software release, a counter added in the middle) would be read into the wrong counters
without an error. Here the headers of all files are found in one distributed pass, files
of the same header are read together with Spark's CSV reader, and the parts are
united by name. Files share a few headers, one a release, whatever their number;
``MAX_HEADERS`` bounds them with an error, not by leaving files out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.sources.counters import ERICSSON_SEP, PERIOD_TS_FORMAT

MAX_HEADERS = 256
_IGNORED = "_ignored_"


def header_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, header): the first line of each file that is not empty, one partial/final
    aggregate over a text read (a task sends one line a file). Files without a byte have no row.

    The first line is the one with the smallest row id among those of the file's first
    block: a block is read by one task, in order. A byte order mark is taken off."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value",
        F.monotonically_increasing_id().alias("row"))
    first = lines.where(F.col("at") == 0).groupBy("path").agg(F.min_by("value", "row").alias("header"))
    return first.withColumn("header", F.ltrim(F.col("header"), F.lit("\ufeff")))


def header_names(header: str, sep: str) -> list[str]:
    """Names in a header line: both-side trim, optional double quotes."""
    return [n.strip().strip('"').strip() for n in header.rstrip("\r").split(sep)]


def _bound(names: list[str], schema: T.StructType) -> T.StructType:
    """The schema of a file with this header: registered columns (whatever their case) where
    the header has them; unknown, unnamed and repeated ones are read as text and left out."""
    known, used, out = {f.name.lower(): f for f in schema.fields}, set(), []
    for i, name in enumerate(names):
        f = known.get(name.lower())
        if f is None or f.name in used:
            out.append(T.StructField(f"{_IGNORED}{i}", T.StringType()))
        else:
            used.add(f.name)
            out.append(T.StructField(f.name, f.dataType))
    return T.StructType(out)


def _by_header(spark: SparkSession, paths) -> list[tuple[str, list[str]]]:
    """(header, its files); as many rows as there are files reach the driver, which holds the
    list of files for every read anyway."""
    groups = header_lines(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files"))
    found = groups.orderBy("header").limit(MAX_HEADERS + 1).collect()
    if len(found) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers: are these files of one family?")
    return [(r.header, [_literal(f) for f in r.files]) for r in found]


def _literal(uri: str) -> str:
    """A file's URI as a path that names just this file: decoded, glob signs escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(uri))


def header_drift(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *, sep: str = ERICSSON_SEP) -> DataFrame:
    """One row a file whose header is not the schema's: names that are missing, unknown or
    repeated, and whether the shared ones come in another order."""
    heads = header_lines(spark, paths)
    names = F.transform(F.split(F.rtrim("header", F.lit("\r")), f"\\Q{sep}\\E"), lambda n: F.lower(F.trim(F.trim(F.trim(n), F.lit('"')))))
    want = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    shared = F.filter(F.array_distinct("names"), lambda n: F.array_contains(want, n))
    return (heads.select("path", names.alias("names"))
            .select("path", F.array_sort(F.array_except(want, "names")).alias("missing"),
                    F.array_sort(F.array_except("names", want)).alias("unknown"),
                    (F.size("names") - F.size(F.array_distinct("names"))).alias("repeated"),
                    (shared != F.filter(want, lambda n: F.array_contains("names", n))).alias("reordered"))
            .where((F.size("missing") > 0) | (F.size("unknown") > 0) | (F.col("repeated") > 0) | F.col("reordered")))


def read_by_header(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, *,
                   sep: str = ERICSSON_SEP, ts_format: str = PERIOD_TS_FORMAT, with_source: bool = False) -> DataFrame:
    """All files of ``paths`` (a path, a pattern or a list) with every column bound by name.

    With ``schema``: its columns in its order and types; a column that a file lacks is null
    there, a value that does not parse is null, unknown columns are left out (see
    :func:`header_drift`). Without it: every column that any header names, as text, in order
    of first appearance over the sorted headers; give it to ``typed_from_strings``. A repeated
    name is the first of its columns. A file of only a header has no rows, one without a byte
    no header; if no file has a header the result is empty with the schema's columns."""
    groups = _by_header(spark, paths)
    if schema is None:
        names: dict[str, str] = {}
        for header, _ in groups:
            for n in filter(None, header_names(header, sep)):
                names.setdefault(n.lower(), n)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names.values()])
    extra = [T.StructField("_source_file", T.StringType())] if with_source else []
    out: DataFrame | None = None
    for header, files in groups:
        bound = _bound(header_names(header, sep), schema)
        have = set(bound.names)
        part = (spark.read.schema(bound).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
                .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
                .option("timestampFormat", ts_format).csv(files))
        cols = [F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        part = part.select(*cols, *([F.col("_metadata.file_path").alias("_source_file")] if with_source else []))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], T.StructType([*schema.fields, *extra])) if out is None else out


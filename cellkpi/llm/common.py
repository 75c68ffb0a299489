"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.session import arrow_batches, scratch_path, ship_package  # noqa: F401

MAX_LONG = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_held: dict = {}


def worker_state(key, build: Callable):
    """What a Python worker keeps from task to task (a parser, a codec, tables): one
    state at a time, so the next operator's takes the place of the last one's."""
    if key not in _held:
        _held.clear()
        free_memory()
        _held[key] = build()
    return _held[key]


def free_memory() -> None:
    """Give freed memory back to the system: pools and the allocator keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):        # another C library
        pass


def lean(run: Callable) -> Callable:
    """A function over Arrow batches that leaves no freed memory behind in its worker."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            free_memory()
    return work


_shared: list = []


def share(spark: SparkSession, value):
    """Broadcast ``value``; see :func:`release_shared`."""
    _shared.append(spark.sparkContext.broadcast(value))
    return _shared[-1]


def release_shared() -> None:
    """Executors drop the values shared so far (a plan that still needs one gets it again)."""
    while _shared:
        _shared.pop().unpersist()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and gives exact row counts and sizes to later steps."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_key(col: str = "doc_id") -> Column:
    """doc_id as a long that is never null: a null id stands as the largest."""
    return F.coalesce(F.col(col).cast("long"), F.lit(MAX_LONG))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def held_out(col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4 (null id: false)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def with_schema(df: DataFrame, **extra: str):
    """Schema of ``df`` plus (or with replaced) named columns, for mapInArrow."""
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string
    fields = [f for f in df.schema.fields if f.name not in extra]
    fields = [StructField(f.name, f.dataType, True) for f in fields]
    return StructType(fields + [StructField(n, _parse_datatype_string(t), True) for n, t in extra.items()])

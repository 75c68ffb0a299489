"""Join helpers with an explicit, checked broadcast decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest dimension side we hint as broadcast, in rows and in bytes of its
# values. One row per cell of a national network is a few million rows at
# most; beyond either bound the join falls back to a shuffled sort-merge join
# (AQE may still convert it at run time). Both joins give the same rows.
MAX_BROADCAST_ROWS = 5_000_000
MAX_BROADCAST_BYTES = 512 << 20


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Exact size check (rows and bytes as text of the already pruned,
    deduplicated side; one aggregate)."""
    width = F.lit(0)
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def composite_key(*parts) -> Column:
    """One text key for a multi-column equi-join: each part but the last is
    length-prefixed, so distinct tuples never collide; NULL if any part is
    NULL (a NULL part never matches, as in the multi-column join)."""
    out = []
    for p in parts[:-1]:
        out += [F.length(p).cast("string"), F.lit(":"), p]
    return F.concat(*out, parts[-1])


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, rows: int | None = None) -> DataFrame:
    """Return ``df`` with a broadcast hint if it is proven small, else unchanged.

    The bound is checked by counting the (already pruned and deduplicated)
    dimension, which is cheap for a dimension table and exact, unlike file
    size estimates of compressed parquet.
    """
    small = is_small(df, max_rows) if rows is None else rows <= max_rows
    return F.broadcast(df) if small else df

"""Histogram counters as arrays.

Counter files carry a histogram as flat columns ``name_0 .. name_k``. Stored
as one array column it is one field to scan, join, shuffle and write instead
of ``k + 1``: the wide vendor schemas have thousands of such columns. The names of the bins
stay in the column's metadata (kept by parquet), so specs still address single
bins and reports can be flat again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = "bins"
_BIN = re.compile(r"(.+)_(\d+)")
_NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType)


def vector_families(schema: T.StructType, least: int = 2) -> dict[str, list[str]]:
    """Histograms of a schema: name -> its columns in order. A histogram is at
    least ``least`` numeric columns of one type whose numbers follow each other
    (``_1, _2, _5`` are single counters)."""
    found: dict[str, list[tuple[int, T.StructField]]] = {}
    for f in schema.fields:
        if isinstance(f.dataType, _NUMBERS) and (m := _BIN.fullmatch(f.name)):
            found.setdefault(m[1], []).append((int(m[2]), f))
    out = {}
    for name, bins in found.items():
        bins.sort(key=lambda b: b[0])
        numbers = [n for n, _ in bins]
        if len(bins) >= least and numbers == list(range(numbers[0], numbers[0] + len(bins))) and len({f.dataType for _, f in bins}) == 1:
            out[name] = [f.name for _, f in bins]
    return out


def bin_names(field: T.StructField) -> list[str] | None:
    """Names of the bins of a packed column, None for any other column."""
    return list(field.metadata[BINS]) if isinstance(field.dataType, T.ArrayType) and BINS in (field.metadata or {}) else None


def pack_vectors(df: DataFrame, families: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Each histogram (by default those of ``df``'s schema) as one array column in
    the place of its first bin."""
    families = vector_families(df.schema) if families is None else families
    taken = {c.lower() for c in df.columns}
    of = {b.lower(): name for name, bins in families.items() for b in bins}
    out, done = [], set()
    for c in df.columns:
        name = of.get(c.lower())
        if name is None:
            out.append(F.col(f"`{c}`"))
        elif name not in done:
            done.add(name)
            bins = list(families[name])
            label = name if name.lower() not in taken else f"{name}_{BINS}"
            out.append(F.array(*[F.col(f"`{b}`") for b in bins]).alias(label, metadata={BINS: bins}))
    return df.select(*out)


def unpack_vectors(df: DataFrame) -> DataFrame:
    """Packed columns as flat columns again, under their own names."""
    out = []
    for f in df.schema.fields:
        bins = bin_names(f)
        out += [F.col(f"`{f.name}`")] if bins is None else [F.get(F.col(f"`{f.name}`"), F.lit(i)).alias(b) for i, b in enumerate(bins)]
    return df.select(*out)

"""Aggregates of wide rows, run by run.

A grouped aggregate of hundreds of counters spends its time on single values: each
is read, added and written by itself, once for the partial and once for the final
aggregate. Where the rows of a group already are in one task and next to each other
(``operators.aggregate.deal_groups`` with an order), one pass over Arrow batches does:
the counters of a batch are matrices, and the rows of each run of equal keys are added up
as vectors. What a batch's last run has so far meets the next batch as one row, so
a task holds a batch and a row, however long a run is.

Sums and maxima of doubles, minima and maxima of integers, minima of text; single
columns or elements of packed histograms. ``reducible`` tells; all else is Spark's own aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.session import arrow_batches

BATCH_ROWS = 4096
STEPS = 32                   # runs up to so many rows are added up together, longer ones one by one
_KEYS = (T.StringType, T.TimestampType, T.DateType, T.LongType, T.IntegerType, T.ShortType, T.BooleanType)
_FUNCS = {"double": ("sum", "max"), "bigint": ("min", "max"), "string": ("min",)}
_UFUNC = {"sum": np.add, "max": np.maximum, "min": np.minimum}


class Reduction(NamedTuple):
    """``func(source)`` under ``name``; ``zero``: NULL counts as 0; ``bin``: of an array, this element."""
    name: str
    func: str
    source: str
    zero: bool = False
    bin: int | None = None


def _field(schema: T.StructType, name: str) -> T.StructField | None:
    return next((f for f in schema.fields if f.name.lower() == name.lower()), None)


def reducible(schema: T.StructType, keys: Sequence[str], wanted: Sequence[Reduction]) -> bool:
    """Whether :func:`aggregate_runs` can do this aggregate."""
    for r in wanted:
        f = _field(schema, r.source)
        if f is None:
            return False
        kind = f.dataType.elementType if r.bin is not None and isinstance(f.dataType, T.ArrayType) else f.dataType
        if r.func not in _FUNCS.get(kind.simpleString(), ()) or (r.bin is not None) != isinstance(f.dataType, T.ArrayType):
            return False
        if kind.simpleString() != "double" and (r.zero or r.bin is not None):
            return False
    return bool(keys) and all((f := _field(schema, k)) is not None and isinstance(f.dataType, _KEYS) for k in keys)


# ------------------------------------------------------------------- in a task

def _starts(keys: Sequence[pa.Array]) -> np.ndarray:
    """Where runs of equal keys begin (NULL equals NULL)."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        codes = k.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def fold(ufunc: np.ufunc, m: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The rows of each run of ``m`` put together, in their order."""
    sizes = np.diff(starts, append=len(m))
    if len(starts) == len(m):
        return m
    out = m[starts]
    short = sizes <= STEPS
    for step in range(1, int(sizes[short].max(initial=1))):
        more = np.flatnonzero(short & (sizes > step))
        out[more] = ufunc(out[more], m[starts[more] + step])
    for i in np.flatnonzero(~short):
        out[i] = ufunc.reduce(m[starts[i]:starts[i] + sizes[i]], axis=0)
    return out


def _matrix(column: pa.Array, width: int | None, fill: float) -> tuple[np.ndarray, np.ndarray | None]:
    """(values, which are there, None: all) of a column as one row a record; ``width``: of an array."""
    if width is None:
        values, there = column, None if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)[:, None]
        return values.fill_null(fill).to_numpy(zero_copy_only=False)[:, None], there
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    there = flat.is_valid().to_numpy(zero_copy_only=False) if flat.null_count else np.ones(0, bool)
    values = flat.fill_null(fill).to_numpy(zero_copy_only=False)
    if sizes[0] >= width and (sizes == sizes[0]).all():
        cut = lambda x: x.reshape(len(sizes), -1)[:, :width]
        return cut(values), cut(there) if flat.null_count else None
    place = (np.cumsum(sizes) - sizes)[:, None] + np.arange(width)                 # arrays of other lengths: missing is NULL
    inside = np.arange(width) < sizes[:, None]
    place[~inside] = 0
    out = np.where(inside, values[place], fill) if len(values) else np.full(place.shape, float(fill))
    return out, inside & there[place] if flat.null_count else inside


def _numbers(column: pa.Array, func: str, zero: bool, width: int | None, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    values, there = _matrix(column, width, 0.0 if func == "sum" or zero else -np.inf)
    return fold(_UFUNC[func], values, starts), None if zero or there is None else fold(np.logical_or, there, starts)


def _ordered(column: pa.Array, func: str, starts: np.ndarray) -> pa.Array:
    """Least or greatest value of each run, through the ranks of the distinct values."""
    coded = column.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order) + 1, np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    rank[-1] = none = len(order) if func == "min" else -1
    codes = coded.indices.fill_null(len(order)).to_numpy(zero_copy_only=False)
    found = fold(_UFUNC[func], rank[codes][:, None], starts)[:, 0]
    return coded.dictionary.take(order).take(pa.array(found, mask=found == none))


def _arrays(func: str, numbers: np.ndarray, there: np.ndarray | None) -> list[pa.Array]:
    columns = np.add(numbers.T, 0.0, order="C") if func == "sum" else np.ascontiguousarray(numbers.T)     # a sum is never -0.0
    return [pa.array(c, mask=None if there is None else ~there[:, i]) for i, c in enumerate(columns)]


def _reduce_runs(n_keys: int, sources: list[str], jobs: list[tuple], schema: pa.Schema):
    """``jobs``: (source, func, zero, width or None, [(bin, place in the result)])."""
    def reduced(b: pa.RecordBatch) -> pa.RecordBatch:
        keys = b.columns[:n_keys]
        starts = _starts(keys)
        out = [k.take(pa.array(starts)) for k in keys] + [None] * (len(schema) - n_keys)
        for source, func, zero, width, wanted in jobs:
            column = b.column(n_keys + sources.index(source))
            if pa.types.is_floating(column.type) or width is not None:
                cells = _arrays(func, *_numbers(column, func, zero, width, starts))
            else:
                cells = [_ordered(column, func, starts)]
            for bin_, place in wanted:
                out[place] = cells[bin_ or 0]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    def merged(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Parts of one run, as rows of the result: put together likewise."""
        b = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        starts, out = np.zeros(1, np.int64), [c.slice(0, 1) for c in b.columns]
        for _, func, _, _, wanted in jobs:
            for _, place in wanted:
                c = b.column(place)
                out[place] = _arrays(func, *_numbers(c, func, False, None, starts))[0] if pa.types.is_floating(c.type) else _ordered(c, func, starts)
        return pa.RecordBatch.from_arrays(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            out = reduced(b)
            if last is not None and all(last.column(i).equals(out.column(i).slice(0, 1)) for i in range(n_keys)):
                head = merged([last, out.slice(0, 1)])
                if out.num_rows == 1:
                    last = head
                    continue
                yield head
                out = out.slice(1)
            elif last is not None:
                yield last
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            last = out.slice(out.num_rows - 1)
        if last is not None:
            yield last
    return run


# ------------------------------------------------------------------------ plan

def aggregate_runs(rows: DataFrame, keys: Sequence[str], wanted: Sequence[Reduction]) -> DataFrame:
    """``keys`` and ``wanted`` of each run of rows with equal keys in a partition. The
    rows of a group must be in one partition and next to each other."""
    arrow_batches(rows.sparkSession, BATCH_ROWS)
    schema = rows.schema
    names, places, columns = {}, {}, []
    for r in wanted:                                     # one column for equal reductions
        of = (r.func, r.source.lower(), r.zero, r.bin)
        if of not in places:
            places[of] = len(keys) + len(places)
            columns.append(f"__r{len(columns)}")
            names[of] = columns[-1]
    sources = list(dict.fromkeys(s for _, s, _, _ in places))
    jobs: dict = {}
    for (func, source, zero, bin_), place in places.items():
        jobs.setdefault((source, func, zero), []).append((bin_, place))
    found = [(*of, None if bins[0][0] is None else max(b for b, _ in bins) + 1, bins) for of, bins in jobs.items()]
    given = [*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{s}`").alias(f"__s{i}") for i, s in enumerate(sources)]]
    out = T.StructType([T.StructField(k, _field(schema, k).dataType, True) for k in keys])
    for (_, source, zero, bin_), name in zip(places, columns, strict=True):
        kind = _field(schema, source).dataType
        out.add(name, kind.elementType if bin_ is not None else kind, not zero)        # no NULL to look for
    run = _reduce_runs(len(keys), sources, found, _arrow(out))
    g = rows.select(*given).mapInArrow(run, out)
    return g.select(*[F.col(f"`{k}`") for k in keys],
                    *[F.col(names[r.func, r.source.lower(), r.zero, r.bin]).alias(r.name) for r in wanted])


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)

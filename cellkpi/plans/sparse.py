"""One table for all families: their columns as maps, typed views, one scan for all reports.

Families have columns of their own, so a store of families is read family by family. Here a
row keeps its partition keys as columns and everything else in a map for each kind
of value (whole numbers, doubles, texts, times); a null is an entry that is not there. New
counters or families change no schema.

:func:`typed_view` gives back a family's columns. :func:`report_sparse` aggregates any number
of families in one scan and one exchange: a family's keys and measures are
laid into shared slots by type and function, so the aggregate is as wide as the widest
family, not as all of them together. A map is read whole: a narrow report of wide families
costs more here than in a store of typed columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.functions.scalars import run_id, run_uuid
from cellkpi.operators.select import latest_hours, restrict_to
from cellkpi.operators.spec import KpiSpec, Measure, group_keys, report_columns, spec_entries
from cellkpi.session import scratch_path
from cellkpi.sources.store import PK, read_index, read_store, write_store

# Map column and value type by the type of a field.
_KINDS = ((T.IntegralType, "longs", "bigint"), ((T.DoubleType, T.FloatType), "doubles", "double"),
          (T.StringType, "texts", "string"), (T.TimestampType, "times", "timestamp"))


def _kind(f: T.StructField) -> tuple[str, str]:
    for types, name, value in _KINDS:
        if isinstance(f.dataType, types):
            return name, value
    raise TypeError(f"{f.name}: a sparse table holds no {f.dataType.simpleString()}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_sparse(rows: DataFrame) -> DataFrame:
    """Rows of one family with partition keys -> partition keys and a map a kind of value."""
    entries: dict[str, list[str]] = {name: [] for _, name, _ in _KINDS}
    for f in rows.schema.fields:
        if f.name not in PK:
            name, value = _kind(f)
            entries[name].append(f"named_struct('key', {_quoted(f.name)}, 'value', CAST(`{f.name}` AS {value}))")
    maps = []
    for _, name, value in _KINDS:
        made = f"filter(array({', '.join(entries[name])}), e -> e.value IS NOT NULL)" if entries[name] else "array()"
        maps.append(F.expr(f"CAST(map_from_entries({made}) AS map<string,{value}>)" if entries[name]
                           else f"CAST(map() AS map<string,{value}>)").alias(name))
    return rows.select(*maps, *PK)


def write_sparse(frames: Mapping[str, DataFrame], path: str, *, mode: str = "append") -> str:
    """Families (rows with partition keys; ``pk_ft`` is the name given here) into one store."""
    table = None
    for family, rows in sorted(frames.items()):
        part = to_sparse(rows.withColumn("pk_ft", F.lit(family)))
        table = part if table is None else table.unionByName(part)
    return write_store(table, path, mode=mode)


def _value(f: T.StructField) -> str:
    if f.name in PK:
        return f"`{f.name}`"
    return f"CAST(try_element_at({_kind(f)[0]}, {_quoted(f.name)}) AS {f.dataType.simpleString()})"


def typed_view(table: DataFrame, family: str, schema: T.StructType) -> DataFrame:
    """Rows of a family with the columns of ``schema`` (its folders only); a counter that
    no row has is null, one that ``schema`` lacks is left out."""
    out = [F.expr(_value(f)).alias(f.name) for f in schema.fields if f.name not in PK]
    return table.where(F.col("pk_ft") == family).select(*out, *PK)


def report_sparse(spark: SparkSession, path: str, specs: Mapping[str, KpiSpec], schemas: Mapping[str, T.StructType], *,
                  latest_n: int = 3, grain: str = "hour", run_token: str = "run") -> dict[str, DataFrame]:
    """The reports of all families of ``specs`` over their newest hours, as ``jobs.report`` gives
    them from the typed view of each, at 'rop' or 'hour' grain. One job scans the store,
    aggregates and writes the groups by family; each report reads its own folder."""
    if grain not in ("rop", "hour"):
        raise ValueError("grain must be 'rop' or 'hour'")
    cases: dict[str, list[str]] = {}                      # slot -> WHEN branches
    funcs: dict[str, Measure] = {}                        # measure slot -> aggregate
    types: dict[str, str] = {}
    layout = {}
    for family, spec in sorted(specs.items()):
        fields = {f.name.lower(): f for f in schemas[family].fields}
        used: dict[tuple, int] = {}

        def slot(prefix: str, f: T.StructField, value: str) -> str:
            kind = (prefix, f.dataType.simpleString())
            used[kind] = used.get(kind, -1) + 1
            name = f"{prefix}_{kind[1]}_{used[kind]}"
            types[name] = kind[1]
            cases.setdefault(name, []).append(f"WHEN {_quoted(family)} THEN {value}")
            return name

        entries, keys, measures = spec_entries(spec, schemas[family]), {}, {}
        for k in group_keys(spec, grain):
            f = fields.get(k.lower())
            if f is None:
                raise KeyError(f"{family}: no column {k}")
            if f.name in PK:
                continue
            hour = grain == "hour" and k == spec.hour_key and not isinstance(f.dataType, T.StringType)
            value = f"date_trunc('hour', {_value(f)})" if hour else _value(f)
            keys[k] = slot("key", f, value)
        for m in (e for e in entries if isinstance(e, Measure)):
            f = T.StructField("*", T.LongType()) if m.source == "*" else fields[m.source.lower()]
            name = slot(f"{m.func}_{m.null_policy}", f, "1L" if m.source == "*" else _value(f))
            funcs[name] = Measure(m.func, name, name, m.null_policy)
            measures[m.name] = name
        layout[family] = (entries, keys, measures)

    index = read_index(spark, path).where(F.col("pk_ft").isin(list(specs)))
    table = read_store(spark, path).where(F.col("pk_ft").isin(list(specs)))
    rows = restrict_to(table, latest_hours(index, latest_n))
    flat = rows.select(*PK, *[F.expr(f"CASE pk_ft {' '.join(c)} END").alias(n) for n, c in cases.items()])
    by = [n for n in cases if n not in funcs]
    aggs = [m.column(types) for m in funcs.values()] or [F.count(F.lit(1)).alias("n_rows")]
    kept = scratch_path(spark, "sparse-report")
    flat.groupBy(*PK, *by).agg(*aggs).write.partitionBy("pk_ft").parquet(kept)

    groups, out = read_store(spark, kept) if specs else None, {}
    for family, spec in sorted(specs.items()):
        entries, keys, measures = layout[family]
        g = groups.where(F.col("pk_ft") == family).select(
            *PK, *[F.col(s).alias(k) for k, s in keys.items()], *[F.col(s).alias(m) for m, s in measures.items()])
        rid = run_id(F.col("pk_hr"), run_uuid(run_token, F.col("pk_market")))
        out[family] = report_columns(g, spec, entries, PK, grain, rid)
    return out

"""The two jobs: ingest (counters -> enriched, partitioned store) and report
(store -> KPI aggregate of the newest hours of every market).

There are no loops over markets, dates or hours (the source system runs one
Spark job per market-hour). Building a plan may start small jobs of its own:
the size check of the lookup, and the selection, which is written and read back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellkpi.functions.scalars import (daily_run_id, export_key, run_id, run_uuid)
from cellkpi.operators.enrich import dedup_rows, derive_pk, enrich, with_market_suffix
from cellkpi.operators.joins import MAX_BROADCAST_ROWS
from cellkpi.operators.select import fresh_markets, latest_date_partitions, latest_hours, restrict_to
from cellkpi.operators.spec import KpiSpec, aggregate, sql_feature_aggregate
from cellkpi.sources.counters import split_bad_periods
from cellkpi.sources.export import export_csv, hour_merge_order
from cellkpi.sources.schema import SchemaRegistry, typed_from_strings
from cellkpi.sources.store import filter_families, read_family, read_index, write_store


def enrich_with_pk(counters: DataFrame, lookup: DataFrame, *, oss_col: str, cell_col: str,
                   lookup_cell_col: str, attrs: dict, date_col: str, hour_col: str,
                   family: str | None = None, drop_cols: Sequence[str] = (),
                   dedup_lookup: bool = True, broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Enrichment + partition keys (+ family when the input is a single family)."""
    df = enrich(counters, lookup, oss_col=oss_col, cell_col=cell_col, lookup_cell_col=lookup_cell_col,
                attrs=attrs, drop_cols=drop_cols, dedup_lookup=dedup_lookup, broadcast_rows=broadcast_rows)
    df = derive_pk(df, date_col=date_col, hour_col=hour_col, market_col="HL_Market")
    if family is not None and "pk_ft" not in df.columns:
        df = df.withColumn("pk_ft", F.lit(family))
    return df


def ingest(counters: DataFrame, lookup: DataFrame, store_path: str, *, quarantine_path: str | None = None,
           mode: str = "append", period_col: str = "PERIOD_START_TIME",
           dedup_keys: Sequence[str] = (), dedup_order: Sequence[str] = (),
           types: Sequence[str] | None = None, **enrich_kw) -> DataFrame:
    """Enrich, key and append counters to the store. Rows that have no place in
    it (``sources.counters.is_bad_row``; with ``types`` also families without a
    registered schema) go to ``quarantine_path``, by default a hidden folder
    beside the store: stored + quarantined rows are always the input rows.

    ``dedup_keys`` (e.g. family, OSS, cell, period) keeps one row per record
    when a batch carries re-delivered files: the last by ``dedup_order``.
    Returns the enriched (good) rows as a lazy DataFrame (no longer cached).
    """
    if dedup_keys:
        counters = dedup_rows(counters, dedup_keys, dedup_order, keep="last")
    df = enrich_with_pk(counters, lookup, **enrich_kw)
    # one read of the input for all outputs (store, index, quarantine): the
    # enriched batch is persisted once (memory + disk; lost blocks recompute)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = split_bad_periods(df, period_col, types)
        write_store(good, store_path, mode=mode, cache=False)
        bad.write.mode("append").parquet(quarantine_path or quarantine_of(store_path))
    finally:
        df.unpersist()
    return good


def quarantine_of(store_path: str) -> str:
    """Folder of rows that found no place in the store (hidden from its reads)."""
    return f"{store_path.rstrip('/')}/_quarantine"


def _run_uuid(run_token: str, market_col: str = "pk_market") -> Column:
    return run_uuid(run_token, F.col(market_col))


def _selection_source(store: DataFrame, index: DataFrame | None, families) -> DataFrame:
    """Where partition keys are chosen from: the store's index table when
    given (``sources.store.read_index``), else the store itself."""
    return filter_families(index if index is not None else store, families)


def report(store: DataFrame, spec: KpiSpec, *, latest_n: int = 3, grain: str = "hour",
           families: str | Sequence[str] | None = None, run_token: str = "run",
           per: Sequence[str] | None = None, index: DataFrame | None = None,
           fresh_as_of: str | None = None, fresh_days: int = 3, labels: DataFrame | None = None,
           packed: bool = False) -> DataFrame:
    """KPI aggregate of the newest ``latest_n`` hours of every market (per family).

    With ``fresh_as_of`` ('yyyy-MM-dd') markets whose newest date is
    ``fresh_days`` or more days older are left out (the freshness gate).
    ``labels``: the store's label dictionary (``sources.labels.read_labels``);
    ``packed``: histograms stay arrays.

    Partition choice is a window over the partition index (the index table
    when given, else the store's distinct keys); the store is restricted by
    a broadcast semi join (dynamic partition pruning), then one groupBy over
    all selected partitions at once.
    """
    source = _selection_source(store, index, families)
    sel = latest_hours(source, latest_n, per=per)
    if fresh_as_of is not None:
        gate = fresh_markets(source, fresh_as_of, fresh_days, per=per).where("is_fresh")
        sel = sel.join(gate, [c for c in ("pk_ft", "pk_market") if c in gate.columns], "left_semi")
    store = filter_families(store, families)
    data = restrict_to(store, sel)
    rid = run_id(F.col("pk_hr"), _run_uuid(run_token))
    return aggregate(data, spec, grain=grain, run_id=rid, labels=labels, packed=packed)


def report_daily(store: DataFrame, spec: KpiSpec, *, families=None, run_token: str = "run",
                 per: Sequence[str] | None = None, index: DataFrame | None = None) -> DataFrame:
    """Daily roll-up of the newest date of every market (run id '24-<uuid>')."""
    sel = latest_date_partitions(_selection_source(store, index, families), per=per)
    data = restrict_to(filter_families(store, families), sel)
    return aggregate(data, spec, grain="day", run_id=daily_run_id(_run_uuid(run_token)))


def ingest_families(frames: Mapping[str, DataFrame], registry: SchemaRegistry, lookup: DataFrame, store_path: str,
                    **kw) -> None:
    """Ingest the rows of each family (typed as its registered schema states) into
    one store; a family without a schema goes to the quarantine whole. One job a
    family, as many as the registry has."""
    for family, rows in sorted(frames.items()):
        if family in registry:
            typed = typed_from_strings(rows, registry[family])
            ingest(typed, lookup, store_path, family=family, types=registry.types(), **kw)
        else:
            rows.withColumn("pk_ft", F.lit(family)).write.mode("append").parquet(f"{quarantine_of(store_path)}_families/{family}")


def report_families(spark: SparkSession, store_path: str, specs: Mapping[str, KpiSpec], registry: SchemaRegistry, *,
                    latest_n: int = 3, grain: str = "hour", run_token: str = "run") -> dict[str, DataFrame]:
    """The report of every family that the store's index and ``specs`` share, each
    from its own directory and over its registered counters."""
    index = read_index(spark, store_path)
    held = {r.pk_ft for r in index.select("pk_ft").distinct().collect()}
    return {family: report(read_family(spark, store_path, family, registry[family] if family in registry else None), spec,
                           latest_n=latest_n, grain=grain, run_token=run_token, families=[family], index=index)
            for family, spec in sorted(specs.items()) if family in held}


def with_export_key(rep: DataFrame, lookup: DataFrame, *, prefix: str = "kpiagg",
                    hourly: bool = True, family_in_key: bool = True) -> DataFrame:
    """Attach market suffix and the output key (one output file per key)."""
    df = with_market_suffix(rep, lookup)
    key = export_key(prefix, F.col("pk_date"), F.col("market_suffix"), F.col("pk_market"),
                     hour=F.col("pk_hr") if hourly else F.lit("24"),
                     family=F.col("pk_ft") if family_in_key and "pk_ft" in rep.columns else None)
    return df.withColumn("export_key", key)


def export_report(rep: DataFrame, path: str, *, merge_hours: bool = False) -> str:
    """CSV export; with ``merge_hours`` one file per (date, market, family),
    newest hour first, instead of one per hour."""
    if merge_hours:
        keys = [c for c in ("pk_date", "pk_market", "pk_ft") if c in rep.columns]
        return export_csv(rep.drop("export_key", "market_suffix"), path, keys=keys, order=hour_merge_order())
    return export_csv(rep.drop("market_suffix"), path, keys=("export_key",))


def report_sql_daily(store: DataFrame, select: str, groupby: str, *, time_keys: Sequence[str] = (),
                     families: str | Sequence[str] | None = None, run_token: str = "run",
                     per: Sequence[str] | None = None, index: DataFrame | None = None) -> DataFrame:
    """Daily roll-up of a text spec over the newest date of every market: the time
    keys leave the GROUP BY and stand for the day in the SELECT list; no hour key."""
    sel = latest_date_partitions(_selection_source(store, index, families), per=per)
    data = restrict_to(filter_families(store, families), sel)
    times = {t.lower() for t in time_keys}
    keys = [k.strip() for k in groupby.split(",") if k.strip().lower() not in times]
    data = data.withColumns({t: F.date_trunc("day", F.to_timestamp(F.col(t))).cast("string") if dict(data.dtypes)[t] == "string"
                             else F.date_trunc("day", t) for t in data.columns if t.lower() in times})
    return sql_feature_aggregate(data, select, ", ".join([*keys, *[t for t in data.columns if t.lower() in times]]),
                                 extra_keys=("pk_ft", "pk_date", "pk_market"), run_id=daily_run_id(_run_uuid(run_token)))


def report_sql(store: DataFrame, select: str, groupby: str, *, latest_n: int = 3,
               families: str | Sequence[str] | None = None, run_token: str = "run",
               per: Sequence[str] | None = None, index: DataFrame | None = None) -> DataFrame:
    """Same as :func:`report` for a spec kept as SELECT/GROUP BY text."""
    sel = latest_hours(_selection_source(store, index, families), latest_n, per=per)
    data = restrict_to(filter_families(store, families), sel)
    rid = run_id(F.col("pk_hr"), _run_uuid(run_token))
    return sql_feature_aggregate(data, select, groupby, run_id=rid)

"""Counter store: hive-partitioned parquet by family/date/market/hour."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.sources.labels import write_labels

# Directory layout. The source system nests family/date/market/hour
# directories (REFERENCE_LAYOUT); at scale that is one directory per market
# hour — millions of small files. Default: directories per (family, date),
# rows clustered by (hour, market) inside the files so parquet row-group
# statistics still skip other markets/hours for pushed-down filters.
STORE_PARTITIONS = ("pk_ft", "pk_date")
REFERENCE_LAYOUT = ("pk_ft", "pk_date", "pk_market", "pk_hr")
# Inside a family-day, rows are ordered by hour, then market: a report reads
# the newest hours of a day, and parquet row groups of other hours are then
# skipped by the pushed-down hour filter.
CLUSTER_BY = ("pk_hr", "pk_market")

# Partition index: one row per (family, date, market, hour) with its row
# count, kept next to the store. The leading underscore hides it from reads
# of the store path. Report selection reads this table instead of scanning
# the store: a scan, even of two columns, is split by file size and would
# run one task per ~128 MB of the whole store (~800k tasks at 100 TB) every
# report; the index is a few MB.
INDEX_DIR = "_index"
PK = ("pk_ft", "pk_date", "pk_market", "pk_hr")


def index_path(store_path: str) -> str:
    return f"{store_path.rstrip('/')}/{INDEX_DIR}"


# Rows that one task makes wide and writes: of the widest layout (2,358 bins) about 400 MB pass through it.
WIDE_ROWS_A_TASK = 20_000


def write_store(df: DataFrame, path: str, *, mode: str = "append",
                partition_by: Sequence[str] = STORE_PARTITIONS, cluster_by: Sequence[str] = CLUSTER_BY,
                compression: str = "zstd", max_records_per_file: int = 5_000_000,
                with_index: bool = True, cache: bool = True, row_group_bytes: int | None = None,
                labels: Sequence[str] = (), widen: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Append (or overwrite) rows into the partitioned store.

    ``REBALANCE`` on the partition keys groups each directory's rows into few
    files, and lets AQE split an oversized (skewed) family-day over several
    tasks instead of one; rows are then sorted by ``cluster_by`` inside each
    task so files carry tight min/max stats; ``maxRecordsPerFile`` bounds
    file size.

    ``with_index`` also maintains the partition index: the batch is persisted
    (memory, spilling to disk; a lost executor's blocks are recomputed from
    lineage) so the index aggregate reuses it instead of reading the input a
    second time. The index is written with the store's mode, partitioned by
    (family, date): an append adds the batch's keys, a dynamic overwrite
    replaces exactly the family-days the store write replaced. ``cache=False``
    when the caller has already persisted ``df`` (or its parent). ``labels``: text
    columns whose distinct values go to the store's label dictionary.

    ``widen`` adds wide counters to the rows; it is called after they are dealt to tasks
    and sorted, so only narrow rows are shuffled. Their bytes say nothing about the files
    then, so instead of ``REBALANCE`` they are dealt by ranges of the sort columns (rows of equal keys by
    a hash), ``WIDE_ROWS_A_TASK`` a task: a large family-day is several tasks here too.
    """
    cols = [c for c in partition_by if c in df.columns]
    sort = [c for c in (*cols, *cluster_by) if c in df.columns]
    index = with_index and all(c in df.columns for c in PK)
    overwrite = {"partitionOverwriteMode": "dynamic"}      # whatever the session says: only touched family-days
    own_cache = index and cache
    if own_cache:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if widen is None:
            rows = df.hint("rebalance", *cols).sortWithinPartitions(*sort)
        else:
            parts = max(1, -(-df.count() // WIDE_ROWS_A_TASK))
            rows = widen(df.repartitionByRange(parts, *sort, F.xxhash64(*df.columns)).sortWithinPartitions(*sort))
        w = (rows.write.mode(mode).options(**overwrite)
               .option("compression", compression).option("maxRecordsPerFile", max_records_per_file))
        if row_group_bytes:
            w = w.option("parquet.block.size", row_group_bytes)
        w.partitionBy(*cols).parquet(path)
        if labels:
            write_labels(df, path, labels)
        if index:
            write_index(df, path, mode=mode, overwrite_mode="dynamic")
    finally:
        if own_cache:
            df.unpersist()
    return path


def write_index(rows: DataFrame, store_path: str, *, mode: str = "append",
                partition_by: Sequence[str] = ("pk_ft", "pk_date"), overwrite_mode: str = "dynamic") -> str:
    """Partition keys and row counts of ``rows`` into the store's index.

    One partial/final aggregate: its output has one row per partition key,
    bounded by families x dates x markets x 24, not by the data. Extra
    ``partition_by`` columns (e.g. a stream's batch id) become part of the
    key, so a retried batch overwrites its own index rows.
    """
    keys = list(dict.fromkeys([*PK, *partition_by]))
    idx = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    w = idx.repartition(*partition_by).write.mode(mode).option("partitionOverwriteMode", overwrite_mode)
    w.partitionBy(*partition_by).parquet(index_path(store_path))
    return index_path(store_path)


def read_index(spark: SparkSession, store_path: str) -> DataFrame:
    """The store's partition index: distinct keys with their total row count.

    Appends may list a key more than once (late rows for an old hour); the
    counts are summed. Keys are text, as from :func:`read_store`.
    """
    idx = _normalise(spark.read.parquet(index_path(store_path)))
    return idx.groupBy(*PK).agg(F.sum("n_rows").alias("n_rows"))


def rebuild_index(spark: SparkSession, store_path: str) -> str:
    """Recompute the whole index from the store (repair path; one full scan of
    the partition-key columns). A stream-landed store keeps its batch-keyed
    index layout."""
    st = read_store(spark, store_path)
    layout = ("pk_ft", "pk_date", "pk_batch") if "pk_batch" in st.columns else ("pk_ft", "pk_date")
    write_index(st.select(*PK, *layout[2:]), store_path, mode="overwrite", partition_by=layout,
                overwrite_mode="static")
    return index_path(store_path)


def compact_index(spark: SparkSession, store_path: str, *, since: str | None = None) -> str:
    """Rewrite the index as one file per (family, date).

    Every appended batch leaves one small file per family-day it touched;
    compaction merges them (summing the counts per key). ``since``
    ('yyyy-MM-dd') restricts the rewrite to the recent days that still
    receive data. The merged rows are checkpointed first (reliable, under
    ``spark.checkpoint.dir``): a plan may not overwrite the files it reads,
    and the checkpoint cuts that lineage. Only the rewritten family-days are
    replaced (dynamic overwrite).
    """
    from cellkpi.session import checkpoint_root

    if "pk_batch" in spark.read.parquet(index_path(store_path)).columns:
        return index_path(store_path)        # batch-keyed (stream) index: one file per family-day and batch already
    checkpoint_root(spark)
    idx = read_index(spark, store_path)
    if since is not None:
        idx = idx.where(F.col("pk_date") >= since)
    idx = idx.repartition("pk_ft", "pk_date").checkpoint(eager=True)
    (idx.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("pk_ft", "pk_date").parquet(index_path(store_path)))
    return index_path(store_path)


def read_store(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read the store; partition keys come back as text ('2024-01-05', '07').

    Partition inference would type pk_date as date and pk_hr as int ('07' ->
    7); normalizing here keeps keys identical to what was written. Filters
    on these columns still prune partitions (they only reference partition
    columns). A store of several families is read family by family
    (:func:`read_family`): their columns differ.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return _normalise(r.parquet(path))


def read_family(spark: SparkSession, path: str, family: str, schema: T.StructType | None = None) -> DataFrame:
    """One family of a store that holds many: its directory only, with its own
    columns. ``schema`` (the registered one) names the counters; of the store's
    other columns only keys and enrichment are added, so a spec expands over the
    family's registered counters whatever other families or old files carry."""
    df = _normalise(spark.read.option("basePath", path).option("mergeSchema", schema is None)
                    .parquet(f"{path.rstrip('/')}/pk_ft={family}"))
    if schema is None:
        return df
    known = {f.name.lower() for f in schema.fields}
    extra = [c for c in df.columns if c.lower().startswith(("pk_", "hl_"))]
    have = {c.lower(): c for c in df.columns}
    cols = [F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) if f.name.lower() in have
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *[F.col(c) for c in extra if c.lower() not in known])


def _normalise(df: DataFrame) -> DataFrame:
    dt = dict(df.dtypes)
    fixes = {}
    if dt.get("pk_date") == "date":
        fixes["pk_date"] = F.date_format("pk_date", "yyyy-MM-dd")
    if dt.get("pk_hr") in ("int", "bigint"):
        fixes["pk_hr"] = F.lpad(F.col("pk_hr").cast("string"), 2, "0")
    for c in ("pk_ft", "pk_market"):
        if c in dt and dt[c] != "string":
            fixes[c] = F.col(c).cast("string")
    return df.withColumns(fixes) if fixes else df


def scan_partitions(store: DataFrame, *, pk_ft=None, pk_date=None, pk_market=None, pk_hr=None) -> DataFrame:
    """Static partition filter (date / market / hour / family)."""
    cond = F.lit(True)
    for name, v in (("pk_ft", pk_ft), ("pk_date", pk_date), ("pk_market", pk_market), ("pk_hr", pk_hr)):
        if v is None:
            continue
        if name == "pk_hr" and not isinstance(v, (list, tuple)):
            v = f"{int(v):02d}"
        cond = cond & (F.col(name).isin(list(v)) if isinstance(v, (list, tuple)) else (F.col(name) == v))
    return store.where(cond)


def filter_families(store: DataFrame, families: str | Sequence[str] | None) -> DataFrame:
    """Pipe-separated family list (or sequence); empty/None = all families."""
    if families is None or families == "" or families == []:
        return store
    if isinstance(families, str):
        families = [f for f in families.split("|") if f]
    return store.where(F.col("pk_ft").isin(list(families)))

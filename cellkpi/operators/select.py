"""Partition selection over the store's partition index.

The reference walks directory listings on the driver; here the same choices
are window functions over the (tiny) distinct partition-key relation, then a
left-semi join back to the store. The index has one row per
(family, date, market, hour) — bounded by partitions, not by data — and the
semi join's build side is at most N rows per (family, market). It is
written once and read back as a plain scan (see :func:`restrict_to`), so its
broadcast drives dynamic partition pruning of the store scan at run time,
and its hours become a pushed-down filter inside the pruned family-days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PK = ("pk_ft", "pk_date", "pk_market", "pk_hr")


def pk_cols(df: DataFrame) -> list[str]:
    return [c for c in PK if c in df.columns]


def partition_index(store: DataFrame) -> DataFrame:
    """Distinct partition keys of the store — or of its index table
    (``sources.store.read_index``), which every function here accepts in
    place of the store: they only read the partition-key columns."""
    return store.select(*pk_cols(store)).distinct()


def ordered_index(store: DataFrame) -> DataFrame:
    """Index in report order: market asc, date desc, hour desc."""
    cols = pk_cols(store)
    order = ([F.col("pk_ft").asc()] if "pk_ft" in cols else []) + [
        F.col("pk_market").asc(), F.col("pk_date").desc(), F.col("pk_hr").desc()]
    return partition_index(store).orderBy(*order)


def _per(store: DataFrame, per: Sequence[str] | None) -> list[str]:
    if per is None:
        per = ["pk_ft", "pk_market"] if "pk_ft" in store.columns else ["pk_market"]
    return list(per)


def latest_hours(store: DataFrame, n: int = 3, *, per: Sequence[str] | None = None) -> DataFrame:
    """Newest ``n`` available (date, hour) partitions of every market, across dates.

    Not "the last n clock hours": gaps are skipped. ``n`` is 1 to 24.
    """
    if not 1 <= n <= 24:
        raise ValueError("a report takes 1 to 24 hours")
    per = _per(store, per)
    w = Window.partitionBy(*per).orderBy(F.col("pk_date").desc(), F.col("pk_hr").desc())
    return (partition_index(store).withColumn("hour_rank", F.row_number().over(w))
            .where(F.col("hour_rank") <= n))


def latest_hours_latest_day(store: DataFrame, n: int = 3, *, per: Sequence[str] | None = None) -> DataFrame:
    """Newest ``n`` hours inside the newest date of every market only."""
    per = _per(store, per)
    idx = partition_index(store).withColumn(
        "_maxd", F.max("pk_date").over(Window.partitionBy(*per)))
    w = Window.partitionBy(*per).orderBy(F.col("pk_hr").desc())
    return (idx.where(F.col("pk_date") == F.col("_maxd")).drop("_maxd")
            .withColumn("hour_rank", F.row_number().over(w)).where(F.col("hour_rank") <= n))


def latest_date_per_market(store: DataFrame, *, per: Sequence[str] | None = None) -> DataFrame:
    per = _per(store, per)
    return partition_index(store).groupBy(*per).agg(F.max("pk_date").alias("latest_date"))


def latest_date_partitions(store: DataFrame, *, per: Sequence[str] | None = None) -> DataFrame:
    """(family, market, newest date) as a rank filter over the index.

    Same rows as :func:`latest_date_per_market`; written as a filtered
    window so a semi join with it keeps dynamic partition pruning (Spark
    only prunes when the build side carries a selective predicate).
    """
    per = _per(store, per)
    idx = partition_index(store).select(*per, "pk_date").distinct()
    w = Window.partitionBy(*per).orderBy(F.col("pk_date").desc())
    return idx.withColumn("date_rank", F.row_number().over(w)).where(F.col("date_rank") == 1)


def latest_date_overall(store: DataFrame) -> DataFrame:
    return partition_index(store).agg(F.max("pk_date").alias("latest_date"))


def max_hour_across_families(store: DataFrame) -> DataFrame:
    """Newest hour per (date, market) over all counter families."""
    return partition_index(store).groupBy("pk_date", "pk_market").agg(F.max("pk_hr").alias("max_hr"))


def latest_dates(store: DataFrame, k: int = 2) -> DataFrame:
    """Top-k distinct dates (ORDER BY pk_date DESC LIMIT k) — a top-k report."""
    return (partition_index(store).select("pk_date").distinct()
            .orderBy(F.col("pk_date").desc()).limit(k))


def restrict_to(store: DataFrame, selected: DataFrame, *, materialize: bool = True) -> DataFrame:
    """Left-semi join of the store with selected partitions, pruned at run time.

    Every selection built here is bounded by construction, not by data
    volume: latest hours <= n x families x markets rows, latest dates per
    market <= families x markets, top-k dates <= k (e.g. 3 x 50 x 500 =
    75k rows of four short strings, a few MB).

    Dynamic partition pruning of the store scan needs, under AQE, a build
    side whose broadcast the pruning filter can reuse; a selection computed
    through shuffles (index distinct, window) never matches after AQE has
    re-planned it, and Spark then silently replaces the pruning filter by
    ``true`` — the store is read whole (seen in the run-time scan metrics).
    So the selection is written once (a small job) to the shared folder named
    by ``spark.checkpoint.dir`` and read back with a selective marker
    predicate: the build side is a plain scan + filter, the broadcast is
    reused and the scan reads only the selected family-days. Its row count is
    checked before the broadcast hint.
    """
    from cellkpi.operators.joins import small_side
    from cellkpi.session import scratch_path

    keys = [c for c in pk_cols(selected) if c in store.columns]
    if not materialize:
        return store.join(small_side(selected.select(*keys)), keys, "left_semi")

    spark = store.sparkSession
    path = scratch_path(spark, "selection")
    selected.select(*keys).distinct().withColumn("_sel", F.lit(1)).write.parquet(path)
    back = spark.read.parquet(path).where(F.col("_sel") == 1).select(*keys)
    if "pk_hr" in keys:
        # The hours of the selection (at most 24 values, bounded by the hour
        # domain) as a static filter: pushed into the scan it skips the row
        # groups of other hours inside the pruned family-days (the store is
        # clustered by hour), or prunes hour directories in the reference
        # layout. The semi join below stays the exact restriction.
        hours = sorted(r[0] for r in back.select("pk_hr").distinct().collect())
        store = store.where(F.col("pk_hr").isin(hours))
    return store.join(small_side(back), keys, "left_semi")


def top_date_partitions(store: DataFrame, k: int = 2) -> DataFrame:
    """Top-k dates as a rank filter (for pruning joins).

    The window has no partition key, but its input is the distinct dates
    (bounded by the retention period) and Spark applies the rank limit per
    input partition before the single-partition exchange.
    """
    d = partition_index(store).select("pk_date").distinct()
    w = Window.orderBy(F.col("pk_date").desc())
    return d.withColumn("date_rank", F.dense_rank().over(w)).where(F.col("date_rank") <= k)


def rows_in_latest_dates(store: DataFrame, k: int = 2, *, index: DataFrame | None = None) -> DataFrame:
    """Store rows of the top-k dates (inner join to the top-k table as a semi join);
    dates are chosen from ``index`` (the store's index table) when given."""
    return restrict_to(store, top_date_partitions(index if index is not None else store, k))


def fresh_markets(store: DataFrame, as_of: str, within_days: int = 3, *,
                  per: Sequence[str] | None = None) -> DataFrame:
    """Freshness gate: is the newest date of each market younger than ``within_days``?

    ``within_days < 0`` disables the gate (everything is fresh).
    """
    per = _per(store, per)
    ld = latest_date_per_market(store, per=per)
    age = F.datediff(F.to_date(F.lit(as_of)), F.to_date("latest_date"))
    fresh = F.lit(True) if within_days < 0 else (age < within_days)
    return ld.withColumn("age_days", age).withColumn("is_fresh", fresh)

"""Aggregate helpers beyond the spec compiler: vector counters, grouping sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_columns(prefix: str, n: int) -> list[str]:
    return [f"{prefix}_{i}" for i in range(n)]


def vector_sum(df: DataFrame, prefix: str, n: int, keys: Sequence[str], *,
               null_policy: str = "keep") -> DataFrame:
    """Element-wise sum of a flattened histogram ``prefix_0..prefix_{n-1}``.

    Each bin is a separate partial/final sum inside one HashAggregate; the
    result is packed into one array column ``prefix`` (no explode, so the
    shuffle carries one row per group, not n).
    """
    cols = vector_columns(prefix, n)
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0)) if null_policy == "zero" else F.col(c)) for c in cols]
    return df.groupBy(*keys).agg(F.array(*sums).alias(prefix))


def hour_and_day(df: DataFrame, keys: Sequence[str], aggs: Sequence, *,
                 date_col: str = "pk_date", hour_col: str = "pk_hr") -> DataFrame:
    """Hourly and daily totals in one pass (GROUPING SETS); ``grain`` tells them apart."""
    hourly = [date_col, hour_col, *keys]
    daily = [date_col, *keys]
    return df.groupingSets([hourly, daily], *hourly).agg(
        F.when(F.grouping(hour_col) == 1, F.lit("day")).otherwise(F.lit("hour")).alias("grain"), *aggs)


# Rows that one task aggregates at a time, however many the input has: a group of the widest
# spec (300 counters) takes 2.6 KB, so its groups stay in memory.
ROWS_A_TASK = 100_000


def deal_groups(rows: DataFrame, by: Sequence[str], order: Sequence[str] = (),
                derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows`` dealt to tasks by ``by`` (some of the later group keys), sorted by ``order``
    inside them. An aggregate by these and more keys then needs no exchange of its own (nor,
    with ``order`` as its keys, a sort), so wide counters that are added afterwards are never
    shuffled. ``derive`` adds what follows from the rows' own columns (``order`` may name it)
    and is not shuffled either. For keys with few rows each, as records of a cell and hour: rows of one key
    meet in one task before anything is added up."""
    parts = max(1, -(-rows.count() // ROWS_A_TASK))
    dealt = rows.repartition(parts, *by)
    dealt = dealt if derive is None else derive(dealt)
    return dealt.sortWithinPartitions(*order) if order else dealt

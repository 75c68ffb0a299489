"""Counter enrichment: left join to the cell lookup (market, cluster, area, site ...)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellkpi.functions.scalars import UNASSIGNED, oss_key, pk_date_of, pk_hr_of, hour_text
from cellkpi.operators.joins import MAX_BROADCAST_ROWS, composite_key, is_small, small_side

# Lookup attributes appended per vendor/technology: output column -> lookup column.
ERIC_LTE_ATTRS = {"HL_Market": "MARKET", "HL_Cluster": "CLUSTER", "HL_Area": "AREA"}
ERIC_UMTS_ATTRS = {"HL_Market": "MARKET", "HL_Cluster": "CLUSTER", "HL_Area": "AREA", "HL_Site": "SITE"}
NOKIA_ATTRS = {"HL_Sector": "CELL", "HL_Site": "SITE", "HL_Market": "MARKET", "HL_Cluster": "CLUSTER",
               "HL_Market_Suffix": "MARKET_SUFFIX", "HL_Area": "AREA"}

# Join keys per vendor/technology: (counter OSS column, counter cell column, lookup cell column).
JOIN_KEYS = {
    ("ericsson", "lte"): ("OSSName", "EUtranCellFDD", "CELL"),
    ("ericsson", "umts"): ("OSSName", "UtranCell", "CELL"),
    ("nokia", "lte"): ("OSS", "MO_DN2", "CELL_UID"),
    ("nokia", "umts"): ("OSS", "CELL_ID_1", "CELL_UID"),
}
ATTRS = {
    ("ericsson", "lte"): ERIC_LTE_ATTRS,
    ("ericsson", "umts"): ERIC_UMTS_ATTRS,
    ("nokia", "lte"): NOKIA_ATTRS,
    ("nokia", "umts"): NOKIA_ATTRS,
}


def prepare_lookup(lookup: DataFrame, cell_col: str, attrs: Mapping[str, str], *,
                   oss_col: str | None = "OSS", dedup: bool = True) -> DataFrame:
    """Project the lookup to (oss key, cell key, attributes).

    With ``dedup`` one row per key survives: the smallest attribute tuple, a
    deterministic choice computed as a partial/final aggregate (no window, so
    a key repeated many times collapses map-side) so duplicated keys never
    multiply counter rows.
    """
    cols = list(dict.fromkeys(attrs.values()))
    okey = [oss_key(oss_col).alias("_lkey_oss")] if oss_col is not None else []
    lk = lookup.select(*okey, F.col(cell_col).cast("string").alias("_lkey_cell"), *[F.col(a).alias(f"_lk_{a}") for a in cols])
    if dedup:
        keys = (["_lkey_oss"] if oss_col is not None else []) + ["_lkey_cell"]
        lk = (lk.groupBy(*keys)
                .agg(F.min(F.struct(*[f"_lk_{a}" for a in cols])).alias("_v"))
                .select(*keys, *[F.col(f"_v._lk_{a}").alias(f"_lk_{a}") for a in cols]))
    return lk


def enrich(counters: DataFrame, lookup: DataFrame, *, oss_col: str | None, cell_col: str,
           lookup_cell_col: str, attrs: Mapping[str, str], dedup_lookup: bool = True,
           drop_cols: Sequence[str] = (), broadcast_rows: int = MAX_BROADCAST_ROWS,
           lookup_filter: Column | None = None) -> DataFrame:
    """``SELECT k.*, IFNULL(l.X,'unassigned') AS HL_X ... LEFT JOIN lookup l
    ON UPPER(k.oss)=UPPER(l.OSS) AND k.cell=l.cell``.

    Unmatched rows survive with 'unassigned'; a NULL OSS never matches. The
    lookup (one row per cell) is broadcast only when its counted size is at
    most ``broadcast_rows``. A larger lookup is joined by shuffle on one
    composite key: the dedup aggregate already hash-partitions the lookup by
    (oss, cell), and joining on those columns would reuse that exchange —
    which leaves AQE no shuffle to split on the lookup side, so a hot cell
    (a third of all counter rows) would stay in one task. With the composite
    key the join gets its own exchanges and AQE's skew join splits the hot
    partition of the counters (replicating the lookup's matching partition).

    Cell keys are compared as text on every path (a number equals the same
    digits only: 7 is '7', not '07'), so the size of the lookup never changes
    the answer; empty keys match empty keys, NULL keys match nothing.

    Older key variants: ``oss_col=None`` joins on the cell alone;
    ``lookup_filter`` restricts the lookup first (e.g. ``TECH = 'LTE'``).
    """
    drop = {d.lower() for d in drop_cols}
    k = counters.drop(*[c for c in counters.columns if c.lower() in drop])
    if lookup_filter is not None:
        lookup = lookup.where(lookup_filter)
    lk = prepare_lookup(lookup, lookup_cell_col, attrs, oss_col="OSS" if oss_col is not None else None,
                        dedup=dedup_lookup)
    if is_small(lk, broadcast_rows):
        lk = F.broadcast(lk)
        cond = k[cell_col].cast("string") == lk["_lkey_cell"]
        if oss_col is not None:
            cond = (oss_key(k[oss_col]) == lk["_lkey_oss"]) & cond
    else:
        lk_oss = F.col("_lkey_oss") if oss_col is not None else F.lit("")
        k_oss = oss_key(k[oss_col]) if oss_col is not None else F.lit("")
        lk = lk.withColumn("_lkey", composite_key(lk_oss, F.col("_lkey_cell")))
        cond = composite_key(k_oss, k[cell_col].cast("string")) == lk["_lkey"]
    out_cols = [k[c] for c in k.columns] + [
        F.coalesce(lk[f"_lk_{src}"], F.lit(UNASSIGNED)).alias(name) for name, src in attrs.items()]
    return k.join(lk, cond, "left").select(*out_cols)


def enrich_for(counters: DataFrame, lookup: DataFrame, vendor: str, tech: str, **kw) -> DataFrame:
    """Enrichment with the reference key/attribute layout of a vendor + technology."""
    oss_col, cell_col, lcell = JOIN_KEYS[(vendor, tech)]
    drop = ("HL_Market",) if vendor == "ericsson" else ()
    return enrich(counters, lookup, oss_col=oss_col, cell_col=cell_col, lookup_cell_col=lcell,
                  attrs=ATTRS[(vendor, tech)], drop_cols=kw.pop("drop_cols", drop), **kw)


def derive_pk(df: DataFrame, *, date_col: str = "HL_DATE", hour_col: str = "PERIOD_START_TIME",
              market_col: str = "HL_Market") -> DataFrame:
    """Store partition keys: pk_market, pk_date (yyyy-MM-dd), pk_hr (HH)."""
    return df.withColumns({
        "pk_market": F.col(market_col),
        "pk_date": pk_date_of(date_col),
        "pk_hr": pk_hr_of(hour_col),
    })


def derive_hl_date(df: DataFrame, period_col: str = "PERIOD_START_TIME") -> DataFrame:
    """Nokia hour stamps: HL_Date = period start, HL_Date_Hour = its hour as text."""
    return df.withColumns({"HL_Date": F.col(period_col), "HL_Date_Hour": hour_text(period_col)})


def market_suffix(lookup: DataFrame) -> DataFrame:
    """Distinct (MARKET, MARKET_SUFFIX) pairs."""
    return lookup.select("MARKET", "MARKET_SUFFIX").distinct()


def with_market_suffix(df: DataFrame, lookup: DataFrame, market_col: str = "pk_market",
                       default: str = "null") -> DataFrame:
    """Attach the market's file-name suffix; unknown markets get ``default``.

    The suffix table has one row per market (bounded by the number of
    markets), so it is broadcast after a size check.
    """
    ms = (lookup.groupBy(F.col("MARKET").alias("_ms_market"))
                .agg(F.min("MARKET_SUFFIX").alias("_ms_suffix")))
    ms = small_side(ms)
    out = df.join(ms, df[market_col] == ms["_ms_market"], "left")
    return out.withColumn("market_suffix", F.coalesce(F.col("_ms_suffix"), F.lit(default))).drop("_ms_market", "_ms_suffix")


def dedup_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, keep: str = "last") -> DataFrame:
    """One row per key — re-delivered records: the row with the largest
    (``keep='last'``) or smallest (``'first'``) ``order`` tuple, ties broken
    by the remaining columns, so the choice is deterministic.

    Written as a max/min over a struct, i.e. a partial + final aggregate:
    the copies of a record collapse inside each map task before the shuffle,
    so a record delivered a million times costs one row per task, never a
    whole group in one task (a window would sort every copy in one task).
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    pick = (F.max if keep == "last" else F.min)(packed).alias("_row")
    keyed = F.lit(True)
    for c in keys:
        keyed = keyed & F.col(f"`{c}`").isNotNull()
    out = df.where(keyed).groupBy(*keys).agg(pick)
    out = out.select(*[F.col(f"`{c}`") if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])
    return out.unionByName(df.where(~keyed))     # rows without a whole key re-deliver nothing; all stay

"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by (hash of the text, hash of the row), so equal texts stand
together. The key space is cut by probes; one aggregate counts the exact bytes
and rows between neighbouring probes over all partitions; spans that hold a
wanted splitter too loosely, or too many rows, get finer probes, and so on
until every splitter is within ``TOLERANCE`` of its place. Splitters are
probes, so each span lies in one shard: a row's slot is the rows before its
span plus its number within the span, and rows are exchanged once, by span.
A splitter avoids cutting a group of equal texts where its tolerance allows
it; larger groups are cut, as the law is near-equal bytes.

Bounds: ``SPANS`` first spans, and finer ones only for at most one span per
splitter and those with over ``HEAVY`` times the mean rows, so the span table
(collected and broadcast) stays at a few thousand rows at any input size.

Defined cases: a null text has no bytes (size 1); a null doc_id or rows that
repeat are rows like any other, each with its own slot (a stored row hash
tells them apart); an empty table gives an empty result; other columns come
along if named in ``carry``; input columns named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellkpi.llm.common import materialise, table, text_or_empty

LAW = "bytes"
SPANS_BITS = 12
SPANS = 1 << SPANS_BITS
FINER = 64                   # new spans of a refined one
HEAVY, HEAVY_ROWS = 8, 128   # a span is refined beyond HEAVY * mean rows, HEAVY_ROWS at least
TOLERANCE = 0.01             # of a shard's ideal bytes
MAX_ROUNDS = 24


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    text = text_or_empty()
    half = lambda h: F.shiftrightunsigned(h, 1)  # noqa: E731  63 bits, so order is plain
    keys = {"__size": F.octet_length(text).cast("long") + 1, "__crc": F.crc32(text.cast("binary")),
            "__hi": half(F.xxhash64(text)),
            "__lo": half(F.xxhash64(F.monotonically_increasing_id(), F.lit("row")))}
    return docs.select(*carry, *(c.alias(n) for n, c in keys.items()))


def _histogram(rows: DataFrame) -> list:
    return (rows.groupBy("__span")
            .agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows"),
                 *(f(F.struct("__hi", "__lo")).alias(n) for n, f in (("first", F.min), ("last", F.max))))
            .collect())


def _refine(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """New span numbers for the spans in ``cuts`` (span, by_lo, base, width, new)."""
    values = ", ".join(f"({s}L, {str(by).lower()}, {b}L, {w}L, {n}L)" for s, by, b, w, n in cuts)
    finer = rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(__span, __by_lo, __base, __width, __new)")
    exact = F.expr("__new + (if(__by_lo, __lo, __hi) - __base) div __width")
    return (rows.join(F.broadcast(finer), "__span", "left")
            .withColumn("__span", F.coalesce(exact, F.col("__span")))
            .drop("__by_lo", "__base", "__width", "__new"))


def _splitters(spans: list, shards: int) -> tuple[list[int], list[int]]:
    """For each splitter the index of the span it stands before, and the indexes
    of spans whose refinement would bring a splitter within its tolerance."""
    total = sum(s.bytes for s in spans)
    slack = TOLERANCE * total / shards
    ends, at = [0], 0
    for s in spans:
        at += s.bytes
        ends.append(at)
    whole = [i in (0, len(spans)) or spans[i - 1]["last"]["__hi"] != spans[i]["first"]["__hi"]
             for i in range(len(spans) + 1)]
    cuts, loose = [], []
    for k in range(1, shards):
        target = total * k / shards
        best = min(range(len(ends)), key=lambda i: abs(ends[i] - target))
        kept = min((i for i in range(len(ends)) if whole[i]), key=lambda i: abs(ends[i] - target))
        cuts.append(kept if abs(ends[kept] - target) <= slack else best)
        if abs(ends[best] - target) > slack:
            loose.append(best if ends[best] <= target else best - 1)
    return cuts, loose


def shard_documents(docs: DataFrame, shards: int = 8, carry: list[str] | None = None) -> DataFrame:
    """Columns ``carry`` of ``docs`` (default: all) plus ``size``, ``text_crc32``,
    ``law``, ``shard``, ``slot`` (from 0 without gaps in each shard)."""
    made = ("size", "text_crc32", "law", "shard", "slot")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in made]
    keyed = materialise(_keyed(docs, carry), "shard-keys")
    rows = keyed.withColumn("__span", F.shiftright("__hi", 63 - SPANS_BITS))
    spans, free = _histogram(rows), SPANS
    for _ in range(MAX_ROUNDS):
        spans.sort(key=lambda s: s["first"])
        cuts, loose = _splitters(spans, shards)
        heavy = max(HEAVY_ROWS, HEAVY * sum(s.rows for s in spans) // SPANS)
        wanted = {*loose} | {i for i, s in enumerate(spans) if s.rows > heavy}
        plan = []
        for s in (spans[i] for i in sorted(wanted) if spans[i].rows > 1):
            by_lo = s["first"]["__hi"] == s["last"]["__hi"]
            low, high = (s[e]["__lo" if by_lo else "__hi"] for e in ("first", "last"))
            if by_lo and low == high:
                continue
            plan.append((s["__span"], by_lo, low, -(-(high - low + 1) // FINER), free))
            free += FINER
        if not plan:
            break
        rows = _refine(rows, plan)
        changed = {p[0] for p in plan}
        spans = [s for s in spans if s["__span"] not in changed] + _histogram(rows.where(F.col("__span") >= plan[0][4]))
    return _assign(rows, spans, cuts, carry)


def _assign(rows: DataFrame, spans: list, cuts: list[int], carry: list[str]) -> DataFrame:
    placed, shard, slot = [], 0, 0
    for i, s in enumerate(spans):
        while shard < len(cuts) and i >= cuts[shard]:
            shard, slot = shard + 1, 0
        placed.append((s["__span"], shard, slot))
        slot += s.rows
    spark = rows.sparkSession
    values = ", ".join(f"({a}L, {b}, {c}L)" for a, b, c in placed) or "(-1L, 0, 0L)"
    table_ = spark.sql(f"SELECT * FROM VALUES {values} AS t(__span, shard, __start)")
    number = F.row_number().over(Window.partitionBy("__span").orderBy("__hi", "__lo"))
    return (rows.join(F.broadcast(table_), "__span")
            .select(*carry, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"),
                    F.lit(LAW).alias("law"), "shard", (F.col("__start") + number - 1).alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in slot order within each file."""
    sharded.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs, 8, carry=["doc_id"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Filter interaction audit: what every order of five text filters removes.

Four filters look at one text (few words, few distinct words, many capitals,
odd characters), the fifth at all texts: a document fails it when a smaller
doc_id has the same text. Those duplicates come from compressed radix tries.
Each task first inserts its own texts, so a group of copies leaves it as one
row per least id. What remains is range-partitioned by text prefixes, each
just long enough to tell the sampled texts on both sides apart; a range that
the sample shows to be too heavy for one task (texts that share thousands of
characters) is cut further by text hash. Every range is inserted into a trie
that holds at each terminal the least id of that whole text; a traversal
gives the flags. Documents are then bit masks of failed filters, reduced to
one count per (part, mask, labels), and all orders are read off these counts.

Bounds: ``SAMPLE`` texts of at most ``SAMPLE_CHARS`` characters are collected to choose
the prefixes (they decide only who does the work); a trie holds about
``BUCKET_BYTES`` of text; a part has at most 128 counts.

Defined cases: null text is the empty text, null lang the part ''; a null
doc_id counts as the largest id and has no label; rows that repeat a doc_id
each count, and do not make each other duplicates; a doc_id labelled more than
once is good (toxic) if any of its labels says so; an empty table has no part
and gives no row; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, doc_key, table, text_or_empty

LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
ODD = b"#$%&*|"
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]

SAMPLE = 4096
SAMPLE_CHARS = 4096
MOST_RANGES = 512
BUCKET_BYTES = 24 << 20

_NOT_CAPITAL = bytes(c for c in range(256) if not 65 <= c <= 90)
_ROWS = "bucket int, text binary, did long, part string, mask int, n long"


def text_mask(text: bytes, points: int) -> int:
    """Bits of the filters A to D that a text of ``points`` code points fails."""
    words = text.split()                                  # at ASCII white space
    capitals = len(text.translate(None, _NOT_CAPITAL))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
            | (100 * capitals > MOST_CAPITALS_PERCENT * points) << 2
            | any(c in text for c in ODD) << 3)


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class _Node:
    __slots__ = ("edge", "below", "least", "rows")

    def __init__(self, edge: bytes):
        self.edge, self.below, self.least, self.rows = edge, {}, None, None


class RadixTrie:
    """Compressed trie of whole byte strings; a terminal holds the least id of
    its text and the rows that were inserted there."""

    def __init__(self):
        self.root = _Node(b"")

    def insert(self, text: bytes, ident: int, row) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = _Node(text[at:])
                at = len(text)
            elif text.startswith(child.edge, at):
                at += len(child.edge)
            else:
                k = shared_length(child.edge, text[at:at + len(child.edge)])
                upper = node.below[text[at]] = _Node(child.edge[:k])
                child.edge = child.edge[k:]
                upper.below[child.edge[0]] = child
                child, at = upper, at + k
            node = child
        if node.least is None:
            node.least, node.rows = ident, []
        node.least = min(node.least, ident)
        node.rows.append(row)

    def terminals(self) -> Iterator[tuple[int, list]]:
        """(least id, rows) of every inserted text."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.least is not None:
                yield node.least, node.rows
            todo.extend(node.below.values())


class Ranges:
    """Text ranges between prefixes; a heavy range has several buckets, by hash."""

    def __init__(self, prefixes: list[bytes], buckets: list[int]):
        self.prefixes, self.buckets, self.first = prefixes, buckets, [0]
        for n in buckets:
            self.first.append(self.first[-1] + n)

    def bucket(self, text: bytes) -> int:
        at = bisect_right(self.prefixes, text)
        n = self.buckets[at]
        return self.first[at] + (xxhash.xxh3_64_intdigest(text) % n if n > 1 else 0)


def choose_ranges(sample: list[tuple[bytes, int]], total: int, bucket_bytes: int) -> Ranges:
    """Ranges of about ``bucket_bytes`` out of ``total`` bytes from a sample of
    (text, bytes it stands for)."""
    sample = sorted(sample)
    weight = sum(n for _, n in sample) or 1
    per_range = max(bucket_bytes, total / MOST_RANGES)
    prefixes, loads, load, last = [], [], 0.0, b""
    for text, n in sample:
        if load >= per_range and text != last:
            cut = text[:shared_length(last, text) + 1]              # tells it from the text before
            prefixes.append(cut)
            loads.append(load)
            load = 0.0
        load, last = load + n / weight * total, text
    return Ranges(prefixes, [max(1, -(-int(x) // bucket_bytes)) for x in [*loads, load]])


def text_ranges(texts: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Ranges:
    """Ranges for rows (text not null): the smallest text hash of each of SAMPLE
    residue classes is the sample, so copies do not weigh."""
    rows = texts.select("text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size"))
    found = (rows.groupBy(F.expr(f"pmod(h, {SAMPLE})").alias("r"))
             .agg(F.min("h").alias("h"), F.sum("size").alias("size")).collect())          # SAMPLE rows at most
    if not found:
        return Ranges([], [1])
    short = (rows.where(f"h IN ({','.join(f'{r.h}L' for r in found)})").groupBy("h")
             .agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"), F.max("size").alias("size")).collect())
    total, tasks = sum(r.size for r in found), int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return choose_ranges([(r.text.encode(), max(1, r.size)) for r in short], total, max(1, min(bucket_bytes, total // tasks)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    types = (pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["bucket", "text", "did", "part", "mask", "n"])


def _slices(rows: Iterator[tuple], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += 64 + len(r[1] or b"")
        if size > most_bytes:
            yield _batch(out)
            out, size = [], 0
    yield _batch(out)


def _local(ranges, bucket_bytes: int):
    """Rows of a task: copies of a smaller id in the same trie are decided here and
    travel without their text, the others go to the bucket of their text."""
    def decided(held: list[tuple]) -> Iterator[tuple]:
        trie = RadixTrie()
        for text, did, part, mask in held:
            trie.insert(text, did, (text, did, part, mask))
        for least, rows in trie.terminals():
            first: dict[str, int] = {}
            for text, did, part, mask in rows:
                if did > least:
                    yield did % 1009, None, did, part, mask | DUPLICATE, 1
                else:
                    first[part] = first.get(part, 0) + 1             # the same id more than once
            for part, n in first.items():
                yield ranges.value.bucket(rows[0][0]), rows[0][0], least, part, rows[0][3], n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            points = pc.utf8_length(b.column("text")).to_pylist()
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for text, did, part, k in zip(texts, b.column("did").to_pylist(), b.column("part").to_pylist(), points, strict=True):
                held.append((text, did, part, text_mask(text, k)))
                size += len(text)
                if size > bucket_bytes:
                    yield from _slices(decided(held))
                    held, size = [], 0
        yield from _slices(decided(held))
    return run


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: one trie a bucket, then its duplicate flags."""
    def flagged(trie: RadixTrie) -> Iterator[tuple]:
        for least, rows in trie.terminals():
            for did, part, mask, n in rows:
                yield 0, None, did, part, mask | DUPLICATE * (did > least), n

    trie, now = RadixTrie(), None
    for b in batches:
        ready = []
        for bucket, text, did, part, mask, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if bucket != now:
                ready.extend(flagged(trie))
                trie, now = RadixTrie(), bucket
            if text is None:
                ready.append((0, None, did, part, mask, n))
            else:
                trie.insert(text, did, (did, part, mask, n))
        yield _batch(ready)
    yield from _slices(flagged(trie))


def failed_filters(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(did, part, mask, n) of ``docs`` (doc_id, text, lang): how many rows of a
    document and part fail the filters in ``mask``."""
    spark = docs.sparkSession
    arrow_batches(spark)
    keyed = docs.select(text_or_empty().alias("text"), doc_key().alias("did"), F.coalesce("lang", F.lit("")).alias("part"))
    ranges = text_ranges(keyed, bucket_bytes)
    local = keyed.mapInArrow(_local(spark.sparkContext.broadcast(ranges), bucket_bytes), _ROWS)
    dealt = local.repartition(max(ranges.first[-1], int(spark.conf.get("spark.sql.shuffle.partitions"))), "bucket")
    return (dealt.sortWithinPartitions("bucket").mapInArrow(_flag, _ROWS)
            .groupBy("did", "part", "mask").agg(F.sum("n").alias("n")))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part: ``cells``, its array of (mask, good, toxic, n)."""
    said = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("did"))
            .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")))
    cells = (masks.join(said, "did", "left")
             .groupBy("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"))
             .agg(F.sum("n").alias("n")))
    return cells.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "bad", "n")).alias("cells"))


def audit_orders(counts: DataFrame, orders: list[str] = ORDERS) -> DataFrame:
    """One row per part, order and step of :func:`mask_counts`' result."""
    steps = [(o, k + 1, 1 << FILTERS.index(o[k]), sum(1 << FILTERS.index(f) for f in o[:k])) for o in orders for k in range(len(o))]
    every = ", ".join(f"struct('{o}' AS filter_order, {k} AS step, {bit} AS bit, {before} AS before)" for o, k, bit, before in steps)
    rows = counts.select("part", "cells", F.expr(f"explode(array({every})) AS s")).select("part", "cells", "s.*")

    def total(where: str, value: str = "c.n"):
        return F.expr(f"aggregate(filter(cells, c -> {where}), 0L, (a, c) -> a + {value})")

    fails, early = "(c.mask & bit) != 0", "(c.mask & before) != 0"
    removed = f"{fails} AND NOT {early}"
    return rows.select(
        "part", "filter_order", "step",
        total(f"NOT {early} AND NOT {fails}").alias("kept"), total(removed).alias("removed"),
        total(f"{fails} AND {early}").alias("redundant"), total("c.mask = bit").alias("unique_fails"),
        total(removed, "c.n * c.good").alias("good_lost"), total(removed, "c.n * c.bad").alias("toxic_lost"),
        # of all orders, a document's share falls to each filter that it fails equally often
        total(fails, "c.n * (120 div bit_count(c.mask))").alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return audit_orders(mask_counts(failed_filters(docs), labels))


OP11_SQL = """
WITH docs AS (
  SELECT coalesce(doc_id, 9223372036854775807) AS did, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
worded AS (
  SELECT *, [w FOR w IN string_split_regex(text, '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words,
         min(did) OVER (PARTITION BY text) AS least FROM docs),
masked AS (
  SELECT did, part,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN least < did THEN 16 ELSE 0 END) AS mask FROM worded),
said AS (
  SELECT doc_id AS did, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, count(*) AS n
  FROM masked LEFT JOIN said USING (did) GROUP BY ALL),
filters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INTEGER AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
SELECT part, filter_order, step::INTEGER AS step,
       sum(CASE WHEN mask & before = 0 AND mask & bit = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n * bad ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM cells, steps GROUP BY part, filter_order, step
"""

"""Line dedup over a sharded minimal perfect hash.

Lines are reduced to 128-bit hashes; one pre-aggregated groupBy gives for each
distinct hash the number of documents and the smallest of them. Shards of
about ``keys_per_shard`` distinct hashes become a perfect hash plus arrays of
fingerprints, counts and smallest documents in a shared table. Documents send
only hashes to the shards, probe the arrays there and get back the positions
of lines to drop: a shard's arrays come first and its probes stream past them, so
a task holds one shard and one batch however many lines ask it. Keys found in very
many documents (at most ``HOT_KEYS`` of them by construction) form one more shard,
broadcast and probed where the text is, so no shard task receives a hot line.

Defined cases: null or empty text is one empty line (null stays null);
a null doc_id counts as the largest id; rows that repeat a doc_id are one
document (its lines stay in all of them); an empty table gives an empty
result; columns ``n_lines`` and ``n_dropped`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, doc_key, lean, materialise, share, table, text_or_empty, with_schema
from cellkpi.llm.perfect_hash import LineArrays

SPACE = b" \t\n\x0b\x0c\r"
MIN_POINTS = 10
KEYS_PER_SHARD = 16384
#: The hot shard holds keys of at least ``max(HOT_FLOOR, lines / HOT_KEYS)``
#: documents: HOT_KEYS entries of 36 bytes (9 MB) at the very most. Every cold line
#: probes it too, so it holds whole keys: 32 bits would take some of many lines for hot ones.
HOT_KEYS = 1 << 18
HOT_FLOOR = 1024


def line_hashes(text: str, min_points: int = MIN_POINTS) -> Iterator[tuple[int, bytes]]:
    """(position, 16-byte hash of the key) of each line whose key is long enough."""
    for at, line in enumerate(text.encode().split(b"\n")):
        key = line.strip(SPACE).lower()
        if len(key) >= min_points and (len(key) >= 4 * min_points or len(key.decode()) >= min_points):
            yield at, xxhash.xxh3_128_digest(key)


def _words(hashes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _count_lines(min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[bytes, list[int]] = {}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for key in {h for _, h in line_hashes(text, min_points)}:
                    if (got := seen.get(key)) is None:
                        seen[key] = [doc, doc, 1]
                    else:
                        got[0], got[1], got[2] = min(got[0], doc), max(got[1], doc), got[2] + 1
            h1, h2 = _words(list(seen))
            lo, hi, n = np.array(list(seen.values()), np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (h1, h2, lo, hi, n)],
                                             names=["h1", "h2", "lo", "hi", "n"])
    return lean(run)


def _arrays(rows: pd.DataFrame, whole: bool = False) -> LineArrays:
    shared = rows.lo.to_numpy() != rows.hi.to_numpy()
    counts = np.where(shared, np.maximum(rows.n.to_numpy(), 2), 1)
    return LineArrays.build(rows.h1.to_numpy(), rows.h2.to_numpy(), counts, rows.lo.to_numpy(), whole)


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([{"shard": int(rows.shard.iloc[0])} | _arrays(rows).columns()])


def build_index(docs: DataFrame, min_points: int = MIN_POINTS,
                keys_per_shard: int = KEYS_PER_SHARD) -> tuple[DataFrame, int, LineArrays]:
    """(shards table, number of shards, arrays of the hot keys) for documents
    given as (did long, text not null)."""
    counted = materialise(
        docs.select("did", "text").mapInArrow(_count_lines(min_points), "h1 long, h2 long, lo long, hi long, n long")
        .groupBy("h1", "h2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")),
        "line-keys")
    keys, lines = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-keys // keys_per_shard))
    hot_from = max(HOT_FLOOR, lines / HOT_KEYS)
    hot = counted.where(F.col("n") >= hot_from).toPandas()     # at most lines / hot_from <= HOT_KEYS rows
    index = materialise(
        counted.where(F.col("n") < hot_from).withColumn("shard", F.expr(f"pmod(h1, {shards})"))
        .groupBy("shard").applyInPandas(_build_shard, "shard long, phf binary, prints binary, counts binary, first binary"),
        "line-shards")
    return index, shards, _arrays(hot, whole=True)


def _probes(shards: int, hot, min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, at, hashes = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                for pos, h in line_hashes(text, min_points):
                    row.append(i)
                    at.append(pos)
                    hashes.append(h)
            h1, h2 = _words(hashes)
            cold = np.flatnonzero(hot.value.probe(h1, h2)[0] == 0)
            row = np.array(row, np.int64)[cold]
            ids = b.column("did").to_numpy()[row]
            prints = b.column("print").to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h1[cold] % shards, ids, prints, np.array(at, np.int32)[cold], h1[cold], h2[cold])],
                names=["shard", "did", "print", "pos", "h1", "h2"])
    return lean(run)


_ARRAYS = ["phf", "prints", "counts", "first"]
_PROBE = ["did", "print", "pos", "h1", "h2"]
PROBE_ROWS = 1 << 16         # probes of a shard that are answered at once


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions to drop; rows come by shard, a shard's arrays before its probes."""
    held, arrays = None, None
    waiting: list[pa.RecordBatch] = []

    def answered() -> pa.RecordBatch:
        t = pa.Table.from_batches(waiting)
        waiting.clear()
        did, mark, pos, h1, h2 = (t.column(c).to_numpy() for c in _PROBE)
        n, first = arrays.probe(h1, h2)
        gone = (n >= 2) & (first != did)
        return pa.RecordBatch.from_arrays([pa.array(x[gone]) for x in (did, mark, pos)], names=_PROBE[:3])

    for b in batches:
        shard = b.column("shard").to_numpy()
        is_probe = b.column("phf").is_null().to_numpy(zero_copy_only=False)
        probes = b.select(_PROBE)
        # A run ends where the shard changes and around each row of arrays.
        cuts = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (is_probe[1:] != is_probe[:-1])) + 1).tolist(), len(shard)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            if waiting and (shard[lo] != held or sum(map(len, waiting)) >= PROBE_ROWS):
                yield answered()
            if not is_probe[lo]:
                held, arrays = shard[lo], LineArrays.from_columns(*(b.column(c)[lo].as_py() for c in _ARRAYS))
            elif held == shard[lo]:
                waiting.append(probes.slice(lo, hi - lo))
    if waiting:
        yield answered()


def _apply(hot, min_points: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, total, dropped = [], [], []
            for did, text, drop in zip(*(b.column(c).to_pylist() for c in ("__did", "text", "__drop")), strict=True):
                lines = (text or "").split("\n")
                gone = set(drop or ())
                found = list(line_hashes(text or "", min_points))
                if found:
                    n, first = hot.value.probe(*_words([h for _, h in found]))
                    gone.update(found[i][0] for i in np.flatnonzero((n >= 2) & (first != did)))
                texts.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
                total.append(len(lines))
                dropped.append(len(gone))
            new = {"text": pa.array(texts, pa.string()), "n_lines": pa.array(total, pa.int64()),
                   "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else b.column(c) for c in names], names=names)
    return lean(run)


def dedup_lines(docs: DataFrame, min_points: int = MIN_POINTS, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """All columns of ``docs`` with repeated lines taken out of ``text``, plus
    ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    arrow_batches(spark)
    keyed = docs.select(doc_key().alias("did"), text_or_empty().alias("text"))
    index, shards, hot = build_index(keyed, min_points, keys_per_shard)
    shared = share(spark, hot)
    probes = keyed.select("did", "text", F.xxhash64("text").alias("print")).mapInArrow(
        _probes(shards, shared, min_points), "shard long, did long, print long, pos int, h1 long, h2 long")
    both = index.unionByName(probes, allowMissingColumns=True)
    drops = (both.repartition("shard").sortWithinPartitions("shard", F.col("phf").isNull())
             .mapInArrow(lean(_answer), "did long, print long, pos int")
             .groupBy("did", "print").agg(F.collect_set("pos").alias("__drop"))
             .withColumnsRenamed({"did": "__did", "print": "__print"}))
    out = with_schema(docs, text="string", n_lines="long", n_dropped="long")
    return (docs.drop("n_lines", "n_dropped")
            .withColumns({"__did": doc_key(), "__print": F.xxhash64(text_or_empty())})
            .join(drops, ["__did", "__print"], "left")
            .mapInArrow(_apply(shared, min_points, out.names), out))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                    F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, coalesce(r.first <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

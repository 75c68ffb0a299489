"""Exact top-k inner products by pivot-table elimination.

Vectors are integers. One more coordinate, sqrt(M - |x|^2) with M the largest
squared norm (0 for queries), makes the nearest vectors those of the largest
inner product, so the triangle inequality holds: with precomputed distances to
many pivots, max |d(q, p) - d(x, p)| bounds d(q, x) from below and the score
from above. A block's vectors are put in the order of their nearest pivot and cut
into groups of ``GROUP``; the interval of a group's distances to each pivot bounds
all its vectors at once. Groups are evaluated in the order of their bounds, for the
queries whose bound reaches the k-th score found so far: nothing that could
enter the result is left out, ties included. What is evaluated is a product of matrices,
in the smallest floats that hold every sum of products exactly.

Candidates are packed into blocks of ``BLOCK`` vectors, queries into blocks of
``QUERY_BLOCK``, both in the smallest integers that hold them; every query block meets
every candidate block, and a task leaves at most k rows a query for all blocks it
has met (until it holds ``HELD`` rows). Pivots come from a bounded sample
(``SAMPLE`` vectors); the sample also gives each query a first k-th score, from
which all blocks prune.

Defined cases: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; shorter vectors count as
padded with zeros; rows that repeat an id are one row (the smallest vector),
and a row of the query's own id is never its candidate; equal scores go to the
smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, materialise, table

SCALE = 1024
TOP = 10
SAMPLE = 1024
PIVOTS = 32
BLOCK = 4096
QUERY_BLOCK = 512
GROUP = 64                   # candidates under one bound
FIRST_CHUNK = 64             # candidates evaluated at once; doubles
HELD = 1 << 20               # rows that a task holds before it passes them on
NONE = np.iinfo(np.int64).min           # no k-th score yet


class Space(NamedTuple):
    width: int               # components
    most: float              # largest squared norm
    pivots: np.ndarray       # one a row
    sample_ids: np.ndarray
    sample: np.ndarray

    @property
    def stored(self) -> np.dtype:
        """Integers that hold every component."""
        return np.dtype(np.int16 if self.most < 1 << 30 else np.int32 if self.most < 1 << 60 else np.int64)

    @property
    def kind(self) -> np.dtype:
        """Numbers that hold every sum of products exactly: none exceeds ``most``."""
        return exact_kind(self.most)


def exact_kind(most: float) -> np.dtype:
    return np.dtype(np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64)


def _lift(v: np.ndarray, most: float) -> np.ndarray:
    """The added coordinate of candidates."""
    return np.sqrt(np.maximum(most - (v.astype(float) ** 2).sum(axis=1), 0.0))


def _distances(v: np.ndarray, lift: np.ndarray, space: Space) -> np.ndarray:
    p = space.pivots.astype(float)
    x = v.astype(float)
    square = ((x ** 2).sum(1)[:, None] + (p ** 2).sum(1) - 2 * (x @ p.T)
              + (lift[:, None] - _lift(space.pivots, space.most)) ** 2)
    return np.sqrt(np.maximum(square, 0.0))


def choose_pivots(v: np.ndarray, most: float, n: int) -> np.ndarray:
    """Farthest-first traversal in the lifted space."""
    if not len(v):
        return v
    x = np.concatenate([v.astype(float), _lift(v, most)[:, None]], 1)
    at = [int((x ** 2).sum(1).argmax())]
    near = ((x - x[at[0]]) ** 2).sum(1)
    while len(at) < min(n, len(v)) and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(1))
    return v[at]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores, ties by smaller id, in order."""
    return np.lexsort((ids, -scores))[:k]


class Block:
    """Candidates in the order of their nearest pivot, and the least and greatest
    distance of each group of them to each pivot."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, table_: np.ndarray, kind: np.dtype):
        order = np.lexsort((table_.min(axis=1), table_.argmin(axis=1))) if table_.size else np.arange(len(ids))
        self.v, self.ids = v[order].astype(kind), ids[order]
        at = np.arange(0, len(ids), GROUP)
        self.least, self.most = np.minimum.reduceat(table_[order], at), np.maximum.reduceat(table_[order], at)

    def bounds(self, far: np.ndarray, norm: np.ndarray, most: float) -> np.ndarray:
        """Scores that no vector of a group exceeds, for each query and group."""
        gap = np.zeros((len(far), len(self.least)))
        for p in range(far.shape[1]):
            d = far[:, p, None]
            np.maximum(gap, self.least[:, p] - d, out=gap)
            np.maximum(gap, d - self.most[:, p], out=gap)
        square = (norm + most)[:, None]
        return (square - gap ** 2) / 2 + 1 + 1e-6 * square                # room for rounding


def first(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, row by row in order."""
    order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    keep = np.arange(len(row)) - np.repeat(starts, np.diff(starts, append=len(row))) < k
    return row[keep], ids[keep], scores[keep]


def raised(floor: np.ndarray, row: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """``floor`` raised to the k-th of each row's scores (as from :func:`first`)."""
    ends = np.flatnonzero(np.diff(row, append=-1)) if len(row) else np.zeros(0, np.int64)
    full = ends[np.diff(ends, prepend=-1) == k]
    floor = floor.copy()
    floor[row[full]] = np.maximum(floor[row[full]], scores[full])
    return floor


def search_all(q: np.ndarray, own: np.ndarray, far: np.ndarray, floor: np.ndarray, k: int, block: Block, most: float,
               held: tuple | None = None) -> tuple[tuple, np.ndarray, int]:
    """((query rows, ids, scores), floors, vectors evaluated) of many queries in one block.
    ``far``: their distances to the pivots; ``floor``: scores that k vectors are known
    to reach; ``held``: what these queries found in other blocks."""
    bound = block.bounds(far, (q.astype(float) ** 2).sum(axis=1), most)
    q, found, looked = q.astype(block.v.dtype), held or (np.zeros(0, np.int64),) * 3, 0
    order = np.argsort(-bound.max(axis=0, initial=-np.inf), kind="stable")
    at, chunk = 0, max(1, FIRST_CHUNK // GROUP)
    while at < len(order):
        part = order[at:at + chunk]
        at, chunk = at + len(part), chunk * 2
        open_ = bound[:, part] >= floor[:, None]
        rows, part = np.flatnonzero(open_.any(axis=1)), np.sort(part[open_.any(axis=0)])
        if not len(rows):
            continue
        place = (part[:, None] * GROUP + np.arange(GROUP)).ravel()
        place = place[place < len(block.ids)]
        scores = q[rows] @ block.v[place].T
        looked += scores.size
        r, c = np.nonzero(scores >= floor[rows, None].astype(scores.dtype))
        r, ids, scores = rows[r], block.ids[place[c]], scores[r, c].astype(np.int64)
        other = ids != own[r]
        found = first(*(np.concatenate([f, x[other]]) for f, x in zip(found, (r, ids, scores), strict=True)), k)
        floor = raised(floor, found[0], found[2], k)
    return found, floor, looked


def search(q: np.ndarray, own: int, far: np.ndarray, norm: float, floor: float, k: int,
           v: np.ndarray, ids: np.ndarray, table_: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores, vectors evaluated) of one query in one block; see :func:`search_all`."""
    least = np.array([NONE if floor == -np.inf else int(floor)])
    (_, got_ids, got), _, looked = search_all(q[None], np.array([own]), far[None], least, k, Block(v, ids, table_, exact_kind(most)), most)
    return got_ids, got, looked


def integer_vectors(df: DataFrame, vector: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col("vec_id").isNotNull() & (F.size(vector) > 0) & usable)
            .select(F.col("vec_id").cast("long"), scaled.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(rows: list, width: int, kind=np.int64) -> np.ndarray:
    out = np.zeros((len(rows), width), kind)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _space(vectors: DataFrame, pivots: int) -> Space:
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    width, most = vectors.agg(F.max(F.size("v")), F.max(square)).first()
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    sample = _matrix([r.v for r in rows], width or 0)
    most = float(most or 0.0)
    return Space(width or 0, most, choose_pivots(sample, most, pivots), np.array([r.vec_id for r in rows], np.int64), sample)


def _pack_candidates(space):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = space.value
        v, ids = _matrix(rows.v.tolist(), s.width, s.stored), rows.vec_id.to_numpy(np.int64)
        return pd.DataFrame([{"block": int(rows.block.iloc[0]), "ids": ids.tobytes(), "vectors": v.tobytes()}])
    return run


def _pack_queries(space, k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = space.value
        v, ids = _matrix(rows.v.tolist(), s.width, s.stored), rows.vec_id.to_numpy(np.int64)
        scores = (v.astype(s.kind) @ s.sample.astype(s.kind).T).astype(np.int64)
        scores[ids[:, None] == s.sample_ids] = NONE                       # its own vector
        floor = np.partition(scores, -k, axis=1)[:, -k] if len(s.sample_ids) >= k else np.full(len(v), NONE)
        return pd.DataFrame([{"q_block": int(rows.block.iloc[0]), "q_ids": ids.tobytes(), "q_vectors": v.tobytes(), "q_floor": floor.tobytes()}])
    return run


def _search_blocks(space, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        read = lambda raw, n: np.frombuffer(raw, s.stored).reshape(n, s.width)
        at, block, held, floors, n_held = None, None, {}, {}, 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for ids, (row, found, scores) in held.values():
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (ids[row], found, scores)], names=["query_id", "vec_id", "score"])

        for b in batches:
            for r in (dict(zip(b.schema.names, (c[i] for c in b.columns), strict=True)) for i in range(b.num_rows)):
                if r["block"].as_py() != at:
                    at, ids = r["block"].as_py(), np.frombuffer(r["ids"].as_buffer(), np.int64)
                    v = read(r["vectors"].as_buffer(), len(ids))
                    block = Block(v, ids, _distances(v, _lift(v, s.most), s), s.kind)
                name, q_ids = r["q_block"].as_py(), np.frombuffer(r["q_ids"].as_py(), np.int64)
                q = read(r["q_vectors"].as_py(), len(q_ids))
                floor = floors.get(name, np.frombuffer(r["q_floor"].as_py(), np.int64))
                before = held.get(name, (q_ids, None))[1]
                found, floors[name], _ = search_all(q, q_ids, _distances(q, np.zeros(len(q)), s), floor, k, block, s.most, before)
                n_held += len(found[0]) - (len(before[0]) if before else 0)
                held[name] = q_ids, found
            if n_held > HELD:
                yield from passed_on()
                held, n_held = {}, 0
        yield from passed_on()
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = TOP, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, v)
    chosen by the condition ``queries``, against all other rows."""
    spark = vectors.sparkSession
    arrow_batches(spark, 16)                             # a row of the search is a pair of blocks
    vectors = materialise(vectors, "vectors")
    n = vectors.count()
    found = _space(vectors, pivots)
    space = spark.sparkContext.broadcast(found)
    blocks = -(-n // BLOCK) or 1
    q = vectors.where(queries)
    q_blocks = -(-q.count() // QUERY_BLOCK) or 1
    number = lambda of: F.expr(f"pmod(xxhash64(vec_id), {of})")
    cands = (vectors.withColumn("block", number(blocks)).groupBy("block")
             .applyInPandas(_pack_candidates(space), "block long, ids binary, vectors binary"))
    packed = (q.withColumn("block", number(q_blocks)).groupBy("block")
              .applyInPandas(_pack_queries(space, k), "q_block long, q_ids binary, q_vectors binary, q_floor binary"))
    # joined by sorting: the files of the vectors may be much smaller than what would be broadcast
    met = cands.hint("merge").join(packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))), "block")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.mapInArrow(_search_blocks(space, k), "query_id long, vec_id long, score long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(integer_vectors(rows, F.col("embedding")), F.expr("vec_id % 100 = 0"))


OP6_SQL = """
WITH usable AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
vectors AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM usable),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

"""Near-duplicate groups by circulant MinHash.

A document's set holds the hashes of its distinct five-word shingles. One
permutation scatters them over a circle of ``CIRCLE`` places; coordinate k of
the signature is the least value that a second permutation, shifted by k
places, gives to them: two permutations make all coordinates. Signatures are
cut into bands; documents that share a band are candidates.

Documents of equal sets collapse to one node first. Candidates are joined into
connected parts (by ids only), every node's text is brought once to its part,
and links are confirmed there on full sets by exact Jaccard similarity. A part
needs few comparisons: nodes already joined are not compared, and once all
nodes not yet compared lie in one group, the part is done. Parts of over
``CELL_NODES`` nodes or ``CELL_SHINGLES`` shingles are cut into cells, worked
on apart; then the best-linked node of the part visits all its cells, and last
every node of a cell's group that it does not link to, in blocks, visits all
cells: no pair across groups stays uncompared and no task holds more than a
cell and a block.

Defined cases: null or empty text, or one of spaces only, has the empty set
and is linked with nothing; a null doc_id counts as the largest id; rows that
repeat are linked with each other; ties need no rule (the smallest id names a
group); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, doc_key, lean, materialise, table, text_or_empty
from cellkpi.llm.components import components
from cellkpi.llm.perfect_hash import mix

WORDS = 5
SIMILAR = 75                 # per cent
CIRCLE = 1 << 20
BANDS, ROWS = 32, 4          # a pair at 0.75 shares no band with a chance of 5 in a million
CELL_NODES, CELL_SHINGLES = 4096, 1 << 19
BLOCK_NODES = 256            # nodes outside the main group that visit a cell together
SEED = 20_240_731
STRETCH = 1 << 18            # bytes hashed at once


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Value of each byte, white space, multipliers of a shingle's words, and
    the two permutations (the second with its beginning repeated)."""
    rng = np.random.default_rng(SEED)
    letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    factors = rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    scatter = rng.permutation(CIRCLE).astype(np.uint32)
    values = rng.permutation(CIRCLE).astype(np.uint32)
    return letters, space, factors, scatter, np.concatenate([values, values[:BANDS * ROWS]])


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BACK):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def word_hashes(raw: bytes, between: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of lower-cased bytes: differences of a prefix
    sum of byte values times powers, brought back to power 0. ``between`` marks
    the bytes that part words (default: white space)."""
    letters, space, *_ = _tables()
    if between is not None:
        space = between
    b = np.frombuffer(raw, np.uint8)
    word = ~space[b]
    edge = np.diff(word, prepend=False, append=False)
    at = np.flatnonzero(edge)
    start, end = at[::2], at[1::2]
    up, down = _powers(1 << max(18, len(b).bit_length()))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[b] * up[:len(b)], dtype=np.uint64)])
    return mix((total[end] - total[start]) * down[start]), start


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    factors = _tables()[2]
    raws = [(t or "").encode().lower() for t in texts]
    out: list[np.ndarray] = []
    at = 0
    while at < len(raws):
        upto, size = at, 0
        while upto < len(raws) and (upto == at or size + len(raws[upto]) < STRETCH):
            size += len(raws[upto]) + 1
            upto += 1
        h, start = word_hashes(b"\n".join(raws[at:upto]))
        ends = np.cumsum([len(r) + 1 for r in raws[at:upto]])
        cut = np.concatenate([[0], np.searchsorted(start, ends)])
        if len(h) >= WORDS:
            full = h[:len(h) - WORDS + 1] * factors[0]
            for k in range(1, WORDS):
                full = full + h[k:len(h) - WORDS + 1 + k] * factors[k]
            full = mix(full)
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            if z - a >= WORDS:
                out.append(np.unique(full[a:z - WORDS + 1]))
            elif z > a:
                out.append(mix((h[a:z] * factors[:z - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(z - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        at = upto
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Circulant MinHash of a set (not empty)."""
    _, _, _, scatter, values = _tables()
    rows = np.lib.stride_tricks.sliding_window_view(values, BANDS * ROWS)
    places = scatter[(shingles % np.uint64(CIRCLE)).astype(np.int64)]
    least = None
    for i in range(0, len(places), 2048):
        part = rows[places[i:i + 2048]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        key = mix(key + rows[:, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(b.column("text").to_pylist())
        keys = np.concatenate([band_keys(signature(s)) for s in sets if len(s)] or [np.zeros(0, np.int64)])
        ends = np.cumsum([0, *(BANDS if len(s) else 0 for s in sets)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column("did"), b.column("print"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
            names=["did", "print", "n", "node", "bands"])


class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def join(self, x: int, others) -> None:
        for y in others:
            a, b = self.find(x), self.find(int(y))
            if a != b:
                self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while True:
            upper = self.up[self.up]
            if (upper == self.up).all():
                return upper
            self.up = upper


class Cell:
    """Sets side by side, with shingles numbered, for comparing one with all."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.names, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self._flag = np.zeros(len(self.names), bool)

    def linked(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Whether each set is similar to one of ``size`` shingles, of which
        those numbered ``ids`` occur in the cell."""
        self._flag[ids] = True
        common = np.add.reduceat(self._flag[self.ids], self.starts, dtype=np.int64)
        self._flag[ids] = False
        return 100 * common >= SIMILAR * (self.sizes + size - common)

    def own(self, i: int) -> np.ndarray:
        return self.ids[self.starts[i]:self.starts[i] + self.sizes[i]]

    def numbers(self, shingles: np.ndarray) -> np.ndarray:
        """Numbers of foreign shingles that occur here."""
        at = np.searchsorted(self.names, shingles)
        at[at == len(self.names)] = 0
        return at[self.names[at] == shingles]


def link_cell(sets: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """(root of each set, best-linked set): exact groups of a cell."""
    n, cell, groups = len(sets), Cell(sets), Groups(len(sets))
    often = np.bincount(cell.ids, minlength=len(cell.names))
    fame = np.add.reduceat(often[cell.ids], cell.starts) / cell.sizes
    order = np.argsort(-fame, kind="stable")
    todo = np.ones(n, bool)
    best, most = int(order[0]), -1
    roots = groups.roots()
    while True:
        left = order[todo[order]]
        if not len(left):
            break
        open_ = roots[left]
        if (open_ == open_[0]).all() and len(left) < n:
            break
        names, counts = np.unique(open_, return_counts=True)
        outside = left if len(names) == len(left) else left[open_ != names[counts.argmax()]]
        x = int(outside[0])
        todo[x] = False
        hit = np.flatnonzero(cell.linked(cell.own(x), int(cell.sizes[x])))
        if len(hit) > most:
            best, most = x, len(hit)
        groups.join(x, hit[roots[hit] != roots[x]])
        roots = groups.roots()
    return roots, best


def _parts(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, dict[int, tuple]]]:
    """Rows of each key (they come sorted) by node: (visitor, text); repeats fall away."""
    now, rows = None, {}
    for b in batches:
        for *key, nid, visitor, text in zip(*(b.column(c).to_pylist() for c in (*keys, "nid", "visitor", "text")), strict=True):
            if tuple(key) != now:
                if rows:
                    yield now, rows
                now, rows = tuple(key), {}
            rows[nid, visitor] = text
    if rows:
        yield now, rows


def _edge_batch(a: list, b: list, links: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, links)], names=["a", "b", "links"])


def _link_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, node) of every node of each cell; ``links``: size of the group for
    the best-linked node, else 0."""
    out: tuple[list, list, list] = ([], [], [])
    for _, rows in _parts(batches, ["part", "cell"]):
        nids, sets = [k[0] for k in rows], shingle_sets(list(rows.values()))
        roots, best = link_cell(sets) if len(sets) > 1 else (np.zeros(len(sets), np.int64), 0)
        out[0].extend(nids[r] for r in roots)
        out[1].extend(nids)
        out[2].extend(int((roots == roots[best]).sum()) if i == best else 0 for i in range(len(nids)))
        if len(out[0]) >= 4096:
            yield _edge_batch(*out)
            out = ([], [], [])
    yield _edge_batch(*out)


def _link_visitors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (visitor, node) of each cell with the nodes that visit it."""
    out: tuple[list, list, list] = ([], [], [])
    for _, rows in _parts(batches, ["part", "cell", "block"]):
        here = [k for k in rows if not k[1]]
        came = [k for k in rows if k[1]]
        if here and came:
            cell = Cell(shingle_sets([rows[k] for k in here]))
            for k, s in zip(came, shingle_sets([rows[k] for k in came]), strict=True):
                for i in np.flatnonzero(cell.linked(cell.numbers(s), len(s))):
                    if here[i][0] != k[0]:
                        out[0].append(k[0])
                        out[1].append(here[i][0])
                        out[2].append(0)
        if len(out[0]) >= 4096:
            yield _edge_batch(*out)
            out = ([], [], [])
    yield _edge_batch(*out)


_EDGES = "a long, b long, links long"


def _dealt(rows: DataFrame, keys: list[str], work) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys, "nid").mapInArrow(lean(work), _EDGES)


def _visit(cells: DataFrame, visitors: DataFrame) -> DataFrame:
    """Links of ``visitors`` (part, nid, block) with all nodes of their parts."""
    places = cells.select("part", "cell").distinct()
    guests = (cells.join(visitors, ["part", "nid"]).select("part", "nid", "block", "text", F.lit(True).alias("visitor"))
              .join(places, "part"))
    blocks = visitors.select("part", "block").distinct()
    hosts = cells.select("part", "cell", "nid", "text", F.lit(False).alias("visitor")).join(blocks, "part")
    return _dealt(hosts.unionByName(guests), ["part", "cell", "block"], _link_visitors)


def _large_parts(cells: DataFrame, inside: DataFrame) -> DataFrame:
    """(node, root) for the nodes of parts of several cells (part, cell, nid, text),
    given the links found inside each cell."""
    grouped = cells.select("part", "nid").join(
        inside.select(F.col("b").alias("nid"), F.col("a").alias("group"), "links"), "nid")
    famous = (grouped.groupBy("part").agg(F.max_by("nid", F.struct("links", "nid")).alias("nid"))
              .withColumn("block", F.lit(0)))
    met = materialise(_visit(cells, famous).select("a", "b"), "links")
    # groups with a node that the famous one links to are one group with it
    main = (grouped.join(met.select(F.col("b").alias("nid")).unionByName(famous.select("nid")).distinct(), "nid")
            .select("part", "group").distinct())
    outside = grouped.join(main, ["part", "group"], "left_anti").select("part", "nid")
    size = outside.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_NODES).alias("blocks"))
    outside = outside.join(size, "part").select("part", "nid", F.expr("pmod(xxhash64(nid, 1), blocks)").cast("int").alias("block"))
    links = met.unionByName(_visit(cells, outside).select("a", "b")).unionByName(inside.select("a", "b"))
    return components(links)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(did, print, n, component) of each row of ``docs``: its key, the size of
    its set and the smallest key of its group."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(doc_key().alias("did"), text_or_empty().alias("text")).withColumn("print", F.xxhash64("text"))
    signed = materialise(rows.mapInArrow(lean(_sign), "did long, print long, n long, node binary, bands array<long>"), "signed")
    nodes = materialise(
        signed.where("n > 0").groupBy("node")
        .agg(F.min(F.struct("did", "print")).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select("node", "at.did", "at.print", "n", "bands", F.monotonically_increasing_id().alias("nid")), "nodes")
    banded = nodes.select("nid", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("nid").alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    candidates = banded.join(hubs, "band").where("nid <> hub").select(F.col("hub").alias("a"), F.col("nid").alias("b"))
    parts = components(candidates).withColumnRenamed("root", "part")
    placed = parts.join(nodes.select(F.col("nid").alias("node"), "did", "print", "n"), "node").withColumnRenamed("node", "nid")
    size = placed.groupBy("part").agg(F.greatest(F.ceil(F.count("*") / CELL_NODES), F.ceil(F.sum("n") / CELL_SHINGLES)).alias("cells"))
    cut = placed.join(size, "part").withColumn("cell", F.expr("pmod(xxhash64(nid), cells)"))
    cells = materialise(rows.join(cut, ["did", "print"]).select("part", "cell", "cells", "nid", "text"), "cells")
    inside = materialise(_dealt(cells.select("part", "cell", "nid", "text", F.lit(False).alias("visitor")),
                                ["part", "cell"], _link_cells), "inside")
    found = inside.select(F.col("b").alias("nid"), F.col("a").alias("root"))
    large = cells.where("cells > 1").drop("cells")
    if not large.isEmpty():
        large_nodes = large.select("nid").distinct()
        found = (found.join(large_nodes, "nid", "left_anti").unionByName(
            _large_parts(large, inside.join(large_nodes.withColumnRenamed("nid", "b"), "b").select("a", "b", "links"))
            .select(F.col("node").alias("nid"), "root")))
    named = nodes.select("node", "nid", "did").join(found, "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    least = named.groupBy("root").agg(F.min("did").alias("component"))
    named = named.join(least, "root").select("node", "component")
    return (signed.select("did", "print", "n", "node").join(named, "node", "left")
            .select("did", "print", "n", F.coalesce("component", "did").alias("component")))


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key names their group; of rows that repeat, one."""
    found = near_duplicates(docs).where("did = component").select(
        F.col("did").alias("__did"), F.col("print").alias("__print")).distinct()
    return (docs.withColumns({"__did": doc_key(), "__print": F.xxhash64(text_or_empty())})
            .join(found, ["__did", "__print"]).dropDuplicates(["__did", "__print"]).drop("__did", "__print"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        F.col("did").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        (F.col("did") == F.col("component")).alias("kept"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sets s ON s.doc_id = c.a JOIN sets t ON t.doc_id = c.b
  WHERE 100 * c.n >= 75 * (len(s.s) + len(t.s) - c.n)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = s.doc_id
"""

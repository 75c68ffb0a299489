"""Hard-negative mining over a sort-tile-recursive packed R-tree.

Rows are dealt to tiles: slabs of the widest coordinate, cut again by the next
widest. A tile becomes blocks of about ``BLOCK`` rows, each packed into leaves
of ``LEAF`` rows (sort, tile, recurse) below inner nodes and one root, all with
minimum bounding boxes. A box gives, coordinate by coordinate, the interval of
inner products that an anchor can reach in it. Search is best-first: boxes in
the order of their upper ends, none whose interval misses the score window or
ends strictly below the k-th score found so far (an equal end may hold a
smaller id). An anchor's own block gives its first k-th score; root boxes are
then ruled out before anything is exchanged, and only the anchors that a block
can still serve travel to it. The same search runs twice: for the positives of
an anchor (no window, same label), and for the negatives of each positive.

Of equal vectors with equal label only the rows of smallest id that any result
can name take part as candidates (all stay anchors), so a very common vector
is no hot tile; the others cannot be among the first k.

Pages and blocks are joined by sorting: their files are a small part of their size (an
anchor's row comes once for each block it may visit), so by the size of the files Spark
would collect them on the driver and broadcast them.

Bounds: ``SAMPLE`` rows (the smallest hash of each residue class) are collected
to fit the tiles, which decide only who does the work; every row is indexed and results
are exact. A block holds about ``BLOCK`` rows, a page at most about ``PAGE`` anchors.

Defined cases: rows with a null id, label or vector or with a null or
non-finite component take no part; a shorter vector counts as padded with
zeros; rows that repeat an id are one (the least); an anchor without positives
or negatives gives no row; an empty table gives none; sums of products beyond
2**62 raise an error instead of wrapping; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, materialise, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
BLOCK = 4096
LEAF = 64
FANOUT = 8
PAGE = 256
SAMPLE = 4096
DIRECTORY = 256              # root boxes looked at together
PAGES_A_TASK = 8             # of those that meet the root boxes
DIRECTORY_BYTES = 32 << 20   # root boxes that every executor may hold
LOW, HIGH = -(1 << 62), 1 << 62


# ------------------------------------------------------------------ the tree

def tile_order(v: np.ndarray, axes: list[int], leaf: int) -> np.ndarray:
    """Rows in sort-tile-recursive order: leaves are runs of ``leaf`` rows."""
    def pack(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(v[rows, left[0]], kind="stable")]
        leaves = -(-len(rows) // leaf)
        if len(left) == 1 or leaves <= 1:
            return [rows]
        slabs = int(np.ceil(leaves ** (1 / len(left))))
        size = -(-leaves // slabs) * leaf
        return [x for i in range(0, len(rows), size) for x in pack(rows[i:i + size], left[1:])]
    return np.concatenate(pack(np.arange(len(v)), axes)) if len(v) and axes else np.arange(len(v))


class Tiles:
    """Splitters of the coordinates ``axes``, level by level; a tile has several
    blocks if the sample shows more than ``block`` rows in it."""

    def __init__(self, axes: list[int], cuts: list[np.ndarray], blocks: np.ndarray):
        self.axes, self.cuts, self.blocks = axes, cuts, blocks
        self.first = np.concatenate([[0], np.cumsum(blocks)])

    @classmethod
    def fit(cls, sample: np.ndarray, rows: int, block: int) -> Tiles:
        wanted = max(1, min(-(-rows // block), len(sample) // 16))
        axes = [int(a) for a in np.argsort(-sample.std(axis=0), kind="stable")[:3]] if len(sample) else []
        axes = axes[:1 if wanted <= 4 else 2 if wanted <= 32 else 3]
        slabs = int(np.ceil(wanted ** (1 / max(1, len(axes)))))
        cuts, groups = [], [sample]
        for axis in axes:
            level, parts = np.zeros((len(groups), slabs - 1), sample.dtype), []
            for i, g in enumerate(groups):
                values = np.sort(g[:, axis])
                if len(values):
                    level[i] = values[[len(values) * k // slabs for k in range(1, slabs)]]
                at = np.searchsorted(level[i], g[:, axis], side="right")
                parts += [g[at == k] for k in range(slabs)]
            cuts.append(level)
            groups = parts
        share = np.array([len(g) for g in groups]) / max(1, len(sample)) * rows
        return cls(axes, cuts, np.maximum(1, np.ceil(share / block)).astype(np.int64))

    def block_of(self, v: np.ndarray, ids: np.ndarray) -> np.ndarray:
        tile = np.zeros(len(v), np.int64)
        for axis, cuts in zip(self.axes, self.cuts, strict=True):
            slabs = cuts.shape[1] + 1
            tile = tile * slabs + (cuts[tile] <= v[:, axis, None]).sum(axis=1)
        return self.first[tile] + (ids * 0x9E3779B1 >> 7) % self.blocks[tile]


def intervals(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any point of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


class Tree:
    """One block: rows in packed order with the boxes of leaves and inner nodes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, v
        at = np.arange(0, len(v), LEAF)
        self.lo, self.hi = np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)
        at = np.arange(0, len(self.lo), FANOUT)
        self.inner_lo, self.inner_hi = np.minimum.reduceat(self.lo, at), np.maximum.reduceat(self.hi, at)

    def search(self, anchors: np.ndarray, a_ids: np.ndarray, a_labels: np.ndarray, wants: pd.DataFrame,
               k: int, same: bool) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(want, ids, scores) of each want (columns row, lo, hi, bar): the first k
        rows with a score in [lo, hi], none below ``bar``."""
        inner_least, inner_most = intervals(anchors, self.inner_lo, self.inner_hi)
        least, most = intervals(anchors, self.lo, self.hi)
        row, lo, hi, bar = (wants[c].to_numpy() for c in ("row", "lo", "hi", "bar"))
        out, order = [], np.argsort(row, kind="stable")
        starts = np.flatnonzero(np.diff(row[order], prepend=-1))
        for i, j in zip(starts, [*starts[1:], len(order)], strict=True):
            mine = order[i:j]
            r = int(row[mine[0]])
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in mine]
            floor, top = np.maximum(lo[mine], bar[mine]), hi[mine]
            open_inner = ((inner_most[r] >= floor.min()) & (inner_least[r] <= top.max())).nonzero()[0]
            leaves = (open_inner[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            leaves = leaves[leaves < len(self.lo)]
            queue = leaves[np.argsort(-most[r, leaves], kind="stable")]
            right = (self.labels == a_labels[r]) & (self.ids != a_ids[r]) if same else self.labels != a_labels[r]
            for at in range(0, len(queue), FANOUT):
                head = queue[at:at + FANOUT]
                if most[r, head[0]] < floor.min():
                    break                                    # so does every later box
                head = head[((most[r, head, None] >= floor) & (least[r, head, None] <= top)).any(axis=1)]
                if not len(head):
                    continue
                rows = (head[:, None] * LEAF + np.arange(LEAF)).ravel()
                rows = rows[rows < len(self.ids)]
                rows = rows[right[rows]]
                scores = (self.v[rows] @ anchors[r]).astype(np.int64)
                for w in range(len(mine)):
                    ok = (scores >= floor[w]) & (scores <= top[w])
                    if ok.any():
                        ids = np.concatenate([found[w][0], self.ids[rows[ok]]])
                        got = np.concatenate([found[w][1], scores[ok]])
                        best = np.lexsort((ids, -got))[:k]
                        found[w] = ids[best], got[best]
                        if len(best) == k:
                            floor[w] = max(floor[w], found[w][1][-1])
            out += [(int(w), *f) for w, f in zip(mine, found, strict=True) if len(f[0])]
        return out


# ------------------------------------------------------- rows, blocks, pages

class Space:
    """Width of the vectors, the types that hold their components and products
    exactly, and the tiles."""

    def __init__(self, width: int, largest: int, tiles: Tiles | None = None):
        if width * largest * largest >= HIGH:
            raise ValueError("inner products beyond 2**62")
        self.width, self.tiles = width, tiles
        self.kind = np.float64 if width * largest * largest < 1 << 53 else np.int64
        self.stored = np.dtype(np.int16 if largest < 1 << 15 else np.int64)

    def matrix(self, rows) -> np.ndarray:
        out = np.zeros((len(rows), self.width), self.stored)
        for i, r in enumerate(rows):
            out[i, :len(r)] = r
        return out

    def read(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.stored).reshape(-1, self.width).astype(self.kind) if self.width else np.zeros((0, 0), self.kind)


def labelled_vectors(df: DataFrame, vector: Column, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v array<long>) of the rows that take part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (df.where(F.col("vec_id").isNotNull() & label.isNotNull() & vector.isNotNull() & usable)
            .select(F.col("vec_id").cast("long"), F.struct(label.cast("long").alias("label"), scaled.alias("v")).alias("s"))
            .groupBy("vec_id").agg(F.min("s").alias("s")).select("vec_id", "s.label", "s.v"))


def _sample(vectors: DataFrame, rows: int = SAMPLE) -> list:
    h = F.xxhash64("vec_id")
    least = vectors.groupBy(F.pmod(h, F.lit(rows)).alias("r")).agg(F.min(h).alias("h")).select("h")
    return vectors.join(F.broadcast(least), h == F.col("h")).select("v").collect()           # at most ``rows`` ids


def _dealt(space, names: list[str]):
    """Adds the block of each row's tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for b in batches:
            v = s.matrix(b.column("v").to_pylist()).astype(s.kind)
            block = s.tiles.block_of(v, b.column("vec_id").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), *(b.column(n) for n in names)], names=["block", *names])
    return run


def _pack_block(space):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        s = space.value
        v = s.matrix(rows.v.tolist())
        order = tile_order(v, list(np.argsort(-v.astype(float).std(axis=0), kind="stable")[:3]), LEAF)
        v = v[order]
        return pd.DataFrame([{"block": int(rows.block.iloc[0]), "ids": rows.vec_id.to_numpy(np.int64)[order].tobytes(),
                              "labels": rows.label.to_numpy(np.int64)[order].tobytes(), "vectors": v.tobytes(),
                              "lo": v.min(axis=0).tobytes(), "hi": v.max(axis=0).tobytes()}])
    return run


def build_index(vectors: DataFrame, space, keep: int) -> DataFrame:
    """One row a block: its packed rows and its root box."""
    copies = Window.partitionBy(F.xxhash64("v"), "label", "v").orderBy("vec_id")
    first = vectors.withColumn("n", F.row_number().over(copies)).where(F.col("n") <= keep).drop("n")
    names = ["vec_id", "label", "v"]
    rows = first.select(names).mapInArrow(_dealt(space, names), "block long, vec_id long, label long, v array<long>")
    return materialise(rows.groupBy("block").applyInPandas(
        _pack_block(space), "block long, ids binary, labels binary, vectors binary, lo binary, hi binary"), "rtree")


_PAGE = "page long, block long, a_ids binary, a_labels binary, a_vectors binary, slots binary, row binary, w_lo binary, w_hi binary, bar binary"


def _page_row(page: int, block: int, ids, labels, v: np.ndarray, wants: pd.DataFrame) -> dict:
    cells = {"slots": wants.slot, "row": wants.row, "w_lo": wants.lo, "w_hi": wants.hi, "bar": wants.bar}
    return {"page": page, "block": block, "a_ids": np.asarray(ids, np.int64).tobytes(), "a_labels": np.asarray(labels, np.int64).tobytes(),
            "a_vectors": v.tobytes(), **{k: c.to_numpy(np.int64).tobytes() for k, c in cells.items()}}


def _read_page(r: dict, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray, pd.DataFrame]:
    n = {k: np.frombuffer(r[k], np.int64) for k in ("a_ids", "a_labels", "slots", "row", "w_lo", "w_hi", "bar")}
    wants = pd.DataFrame({"slot": n["slots"], "row": n["row"], "lo": n["w_lo"], "hi": n["w_hi"], "bar": n["bar"]})
    return n["a_ids"], n["a_labels"], space.read(r["a_vectors"]), wants


def _pack_page(space):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        wants = pd.DataFrame({"slot": 0, "row": np.arange(len(rows)), "lo": LOW, "hi": HIGH, "bar": LOW})
        return pd.DataFrame([_page_row(int(rows.page.iloc[0]), int(rows.block.iloc[0]), rows.vec_id, rows.label,
                                       space.value.matrix(rows.v.tolist()), wants)])
    return run


def anchor_pages(anchors: DataFrame, space, page: int = PAGE) -> DataFrame:
    """Anchors of one block, about ``page`` of them a row, each wanting any score."""
    names = ["vec_id", "label", "v"]
    placed = materialise(anchors.select(names).mapInArrow(_dealt(space, names), "block long, vec_id long, label long, v array<long>"), "anchors")
    parts = placed.groupBy("block").agg(F.ceil(F.count("*") / page).alias("parts"))
    number = F.xxhash64("block", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    return materialise(placed.join(parts, "block").withColumn("page", number).groupBy("page", "block")
                       .applyInPandas(_pack_page(space), _PAGE), "pages")


# ---------------------------------------------------------------- the search

def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    for i in range(b.num_rows):
        yield {n: b.column(n)[i].as_py() for n in b.schema.names}


def _tree(r: dict, s: Space) -> Tree:
    return Tree(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), s.read(r["vectors"]))


def _out(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page": pa.int64(), "block": pa.int64()}
    names = [c.split()[0] for c in _PAGE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.binary())) for n in names], names=names)


def _seed(space, k: int, same: bool):
    """Raises the bar of each want to the k-th score in the anchors' own block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for b in batches:
            for r in _rows(b):
                ids, labels, v, wants = _read_page(r, s)
                if r["ids"] is not None:
                    bar = wants.bar.to_numpy(copy=True)
                    for w, _, scores in _tree(r, s).search(v, ids, labels, wants, k, same):
                        if len(scores) == k:
                            bar[w] = scores[-1]
                    wants = wants.assign(bar=bar)
                yield _out([_page_row(r["page"], r["block"], ids, labels, v.astype(s.stored), wants)])
    return run


def _pack_directory(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    return pd.DataFrame([{"part": int(rows.part.iloc[0]), "blocks": rows.block.to_numpy(np.int64).tobytes(),
                          "d_lo": b"".join(rows.lo), "d_hi": b"".join(rows.hi)}])


def _route(space):
    """For each page and stretch of the directory: the wants that each block can serve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for b in batches:
            for r in _rows(b):
                ids, labels, v, wants = _read_page(r, s)
                blocks = np.frombuffer(r["blocks"], np.int64)
                least, most = intervals(v, *(np.frombuffer(r[c], s.stored).reshape(len(blocks), s.width).astype(s.kind) for c in ("d_lo", "d_hi")))
                row = wants.row.to_numpy()
                open_ = (most[row] >= np.maximum(wants.lo, wants.bar).to_numpy()[:, None]) & (least[row] <= wants.hi.to_numpy()[:, None])
                for at in open_.any(axis=0).nonzero()[0]:
                    mine = wants[open_[:, at]]
                    used, place = np.unique(mine.row, return_inverse=True)
                    yield _out([_page_row(r["page"], int(blocks[at]), ids[used], labels[used], v[used].astype(s.stored), mine.assign(row=place))])
    return run


def _visit(space, k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for b in batches:
            for r in _rows(b):
                ids, labels, v, wants = _read_page(r, s)
                found = _tree(r, s).search(v, ids, labels, wants, k, same)
                row, slot = wants.row.to_numpy(), wants.slot.to_numpy()
                cells = [(np.full(len(i), r["page"]), np.full(len(i), ids[row[w]]), np.full(len(i), slot[w]), i, x) for w, i, x in found]
                columns = [np.concatenate(c) for c in zip(*cells, strict=True)] if cells else [np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["page", "anchor_id", "slot", "vec_id", "score"])
    return run


def search(pages: DataFrame, index: DataFrame, space, k: int, same: bool) -> DataFrame:
    """(page, anchor_id, slot, vec_id, score, rank): the first ``k`` rows of each want."""
    body = index.select("block", "ids", "labels", "vectors")
    seeded = materialise(pages.hint("merge").join(body, "block", "left").select(*pages.columns, "ids", "labels", "vectors")
                         .mapInArrow(_seed(space, k, same), _PAGE), "seeded")
    stretch = F.floor(F.col("block") / DIRECTORY).cast("long")
    directory = materialise(index.select(stretch.alias("part"), "block", "lo", "hi").groupBy("part")
                            .applyInPandas(_pack_directory, "part long, blocks binary, d_lo binary, d_hi binary"), "directory")
    parts, boxes = directory.agg(F.max("part"), F.sum(F.octet_length("d_lo") + F.octet_length("d_hi"))).first()
    directory = F.broadcast(directory) if (boxes or 0) <= DIRECTORY_BYTES else directory.hint("merge")
    # the stated anchors against all root boxes, a page and a stretch at a time
    dealt = seeded.repartition(-(-seeded.count() // PAGES_A_TASK) or 1, "page")
    met = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts or 0)).cast("array<long>"))).join(directory, "part")
    routes = materialise(met.mapInArrow(_route(space), _PAGE), "routes")
    found = routes.hint("merge").join(body, "block").mapInArrow(_visit(space, k, same), "page long, anchor_id long, slot long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return materialise(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")


def _negative_wants(space, least: tuple[int, int], most: tuple[int, int]):
    """Pages whose wants are the score windows of their anchors' positives."""
    def run(pages: pd.DataFrame, positives: pd.DataFrame) -> pd.DataFrame:
        if not len(pages) or not len(positives):
            return pd.DataFrame(columns=[c.split()[0] for c in _PAGE.split(", ")])
        r, s = pages.iloc[0], space.value
        ids, labels, v, _ = _read_page(r, s)
        score, place = positives.score.to_numpy(np.int64), {i: n for n, i in enumerate(ids.tolist())}
        lo = -((-score // least[1]) * least[0] + (-score % least[1]) * least[0] // least[1])       # rounded up
        hi = score // most[1] * most[0] + score % most[1] * most[0] // most[1]
        wants = pd.DataFrame({"slot": positives["rank"].to_numpy(), "row": [place[i] for i in positives.anchor_id], "lo": lo, "hi": hi, "bar": LOW})
        wants = wants[wants.lo <= wants.hi]
        return pd.DataFrame([_page_row(int(r.page), int(r.block), ids, labels, v.astype(s.stored), wants)])
    return run


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: tuple[int, int] = (1, 2), most: tuple[int, int] = (19, 20), block: int = BLOCK) -> DataFrame:
    """For the rows of ``vectors`` (vec_id, label, v) that ``anchors`` chooses and each
    of their first ``positives`` rows of the same label: the first ``negatives`` rows
    of another label that score from ``least`` to ``most`` (fractions) of the positive's."""
    spark = vectors.sparkSession
    arrow_batches(spark, 2048)
    vectors = materialise(vectors, "labelled-vectors")
    n, width, largest = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    space = Space(width or 0, largest or 0)
    space.tiles = Tiles.fit(space.matrix([r.v for r in _sample(vectors)]).astype(space.kind), n, block)
    shared = spark.sparkContext.broadcast(space)
    index = build_index(vectors, shared, max(positives + 1, negatives))
    pages = anchor_pages(vectors.where(anchors), shared)
    arrow_batches(spark, 16)                         # from here on a row is a page with a block
    near = search(pages, index, shared, positives, True)
    wants = materialise(pages.groupBy("page").cogroup(near.groupBy("page"))
                        .applyInPandas(_negative_wants(shared, least, most), _PAGE), "windows")
    far = search(wants, index, shared, negatives, False)
    arrow_batches(spark)
    near = near.select("anchor_id", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (far.select("anchor_id", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .hint("merge").join(near, ["anchor_id", "slot"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(labelled_vectors(rows, F.col("embedding"), label), F.expr("vec_id % 50 = 0"))


OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

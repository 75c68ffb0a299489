"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to ``FEATURES`` features, weighted by their inverse document
frequency over the whole corpus. Randomised SVDs of the benchmark's passages
(rows spread over tasks; only features x rank matrices are ever summed up)
give the latent spaces, one for every ``RANK`` passages at most, so that each
passage lies wholly in its space. Every window of ``2 * HALF`` words of every document,
half a window apart, is projected and compared with all benchmark passages: by
cosine, and by the share of the passage's own weight that the window covers, so
foreign words beside a copy take nothing away. No word weighs less than 1,
however many documents have it. A copy of a passage always has a window that
covers a third of it (three windows hold 64 words). For each candidate the longest common subsequence with the item's
words is measured on the words themselves, and the item's last words (its
answer) are looked for nearby, so reworded passages are found and chance
resemblance falls away.

Bounds: a space has at most ``RANK * PASSAGE`` active features (tables of 17 MB
of floats, sums of 35 MB on the driver); those of ``BLOCK_ITEMS`` passages (272
MB at most) are broadcast at a time, and a larger benchmark takes several passes
over the documents. No text is collected.

Defined cases: null or empty texts contain nothing; items of fewer than
``LEAST_WORDS`` words are found only where they stand word for word; a character
of a script without spaces is a word of its own; items without a word match nothing; null
ids stay null; repeated rows of documents or items give repeated findings only
once per (doc_id, item_id), the best; an empty corpus or benchmark gives an
empty result; other columns are ignored by the finder and kept by the filter.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, doc_key, lean, materialise, share, table, text_or_empty
from cellkpi.llm.near_dup import STRETCH, word_hashes
from cellkpi.llm.perfect_hash import mix

FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
RANK, EXTRA, POWERS = 256, 8, 2
HALF = 16                    # words of half a window
PASSAGE = 64                 # longer items are cut, half overlapping
BLOCK_ITEMS = 4096
LEAST_WORDS = 8
COSINE = 0.35                # of a candidate
COVERED = 0.33               # or the share of the passage's weight in the window
COPIED = 0.8                 # share of the item's words found in order, by itself
REWORDED = 0.5               # the same, if the answer is there too
ANSWER = 4                   # last words of an item
SEED = 7


def _between() -> np.ndarray:
    """Bytes that part words: ASCII other than letters and digits."""
    out = np.zeros(256, bool)
    out[:128] = True
    out[[ord(c) for c in string.ascii_letters + string.digits]] = False
    return out


_PARTING = _between()
#: A character of Thai, Lao, Myanmar, Khmer, kana or Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def _spaced(text: str | None) -> str:
    """``text`` with spaces round the characters of scripts that put none between words."""
    if not text or text.isascii():
        return text or ""
    return _UNSPACED.sub(r" \g<0> ", text)


def words(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word hashes, cuts between texts) of stretches of texts."""
    raws = [_spaced(t).encode().lower() for t in texts]
    at = 0
    while at < len(raws):
        upto, size = at, 0
        while upto < len(raws) and (upto == at or size + len(raws[upto]) < STRETCH):
            size += len(raws[upto]) + 1
            upto += 1
        h, start = word_hashes(b"\n".join(raws[at:upto]), _PARTING)
        ends = np.cumsum([len(r) + 1 for r in raws[at:upto]])
        yield at, h, np.concatenate([[0], np.searchsorted(start, ends)])
        at = upto


def features(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES + 1, np.int64)             # the last one counts documents
    for b in batches:
        for _, h, cut in words(b.column(0).to_pylist()):
            text = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            pairs = np.unique(text * FEATURES + features(h))
            total += np.bincount(pairs % FEATURES, minlength=FEATURES + 1)
            total[-1] += len(cut) - 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["feature", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """Weight of each feature, at least 1, from the number of documents that have it."""
    rows = (texts.mapInArrow(lean(_document_counts), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
            .toPandas())                                  # FEATURES + 1 rows at most
    total = np.zeros(FEATURES + 1)
    total[rows.feature.to_numpy()] = rows.n.to_numpy()
    return 1 + np.log((total[-1] + 1) / (total[:-1] + 1)).astype(np.float32)


class Passage(NamedTuple):
    item: int
    words: list[int]


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        items, out = b.column("item_id").to_pylist(), []
        for at, h, cut in words(b.column("text").to_pylist()):
            for i, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if z > a:
                    firsts = range(0, max(1, z - a - PASSAGE // 2), PASSAGE // 2) if z - a > PASSAGE else [0]
                    out += [{"item_id": items[at + i], "words": h[a + f:min(z, a + f + PASSAGE)].view(np.int64)} for f in firsts]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.int64()))]))


def _word_rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, its feature)."""
    column = b.column("words")
    n = np.array([x or 0 for x in column.value_lengths().to_pylist()], np.int64)
    flat = column.flatten().to_numpy().view(np.uint64)
    return np.repeat(np.arange(len(n)), n), features(flat)


def _project(rows: np.ndarray, at: np.ndarray, n: int, idf: np.ndarray, place: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """TF-IDF rows times a basis over the active features."""
    out = np.zeros((n, basis.shape[1]))
    known = place[at] >= 0
    np.add.at(out, rows[known], basis[place[at[known]]] * idf[at[known], None])
    return out


def _gather(shared, transposed: bool):
    """Sums over the rows of a task: A'A * basis, or the small (A*basis)'(A*basis)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, place, basis = shared.value
        total = np.zeros(basis.shape if transposed else (basis.shape[1],) * 2)
        for b in batches:
            rows, at = _word_rows(b)
            y = _project(rows, at, b.num_rows, idf, place, basis)
            if transposed:
                known = place[at] >= 0
                np.add.at(total, place[at[known]], y[rows[known]] * idf[at[known], None])
            else:
                total += y.T @ y
        for first in range(0, len(total), 1024):
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([total[first:first + 1024].tobytes()], pa.binary())],
                                             names=["first", "part"])
    return lean(run)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for first, part in zip(b.column("first").to_pylist(), b.column("part").to_pylist(), strict=True):
            part = np.frombuffer(part)
            total[first] = total[first] + part if first in total else part
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["first", "part"])


def _sum(passages: DataFrame, idf: np.ndarray, place: np.ndarray, basis: np.ndarray, transposed: bool) -> np.ndarray:
    shared = share(passages.sparkSession, (idf, place, basis))
    shape = "first long, part binary"
    parts = (passages.select("words").mapInArrow(_gather(shared, transposed), shape)
             .repartition("first").mapInArrow(_add_parts, shape).orderBy("first").collect())
    return np.concatenate([np.frombuffer(p.part) for p in parts]).reshape(-1, basis.shape[1])


def latent_space(passages: DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each active feature or -1, right singular vectors over the active
    features) by randomised SVD of the passages' TF-IDF matrix."""
    used = [r[0] for r in passages.select(F.explode("words").alias("w"))
            .select(F.expr(f"shiftrightunsigned(w, {64 - FEATURE_BITS})")).distinct().collect()]   # FEATURES at most
    place = np.full(FEATURES, -1, np.int64)
    place[sorted(used)] = np.arange(len(used))
    rank = min(RANK + EXTRA, len(used))
    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((len(used), rank)))[0]
    for _ in range(POWERS):
        basis = np.linalg.qr(_sum(passages, idf, place, basis, True))[0]
    size, turn = np.linalg.eigh(_sum(passages, idf, place, basis, False))
    keep = size[::-1][:RANK] > 1e-9 * max(size[-1], 1e-30)
    return place, basis @ turn[:, ::-1][:, :RANK][:, keep]


def common_in_order(item: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, by bits of whole integers."""
    masks: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        masks[w] |= 1 << i
    full = (1 << len(item)) - 1
    free = full
    for w in text:
        if m := masks.get(w):
            met = free & m
            free = ((free + met) | (free - met)) & full
    return len(item) - free.bit_count()


def answer_in(item: list[int], text: list[int]) -> bool:
    tail = item[-ANSWER:]
    return any(text[i:i + len(tail)] == tail for i, w in enumerate(text) if w == tail[0])


class Space(NamedTuple):
    passages: list[Passage]
    place: np.ndarray        # row of each feature or -1
    rows: np.ndarray         # what a word of each active feature adds to its window's product with each unit passage
    size: np.ndarray         # norm of each passage


def space_of(passages: list[Passage], idf: np.ndarray, place: np.ndarray, basis: np.ndarray) -> Space:
    """The latent space as a table: a word's image times the images of the passages."""
    rows = basis * idf[place >= 0, None]
    latent = np.zeros((len(passages), basis.shape[1]))
    for i, p in enumerate(passages):
        latent[i] = rows[place[features(np.array(p.words, np.int64).view(np.uint64))]].sum(axis=0)
    size = np.maximum(np.sqrt((latent ** 2).sum(axis=1)), 1e-9)
    return Space(passages, place.astype(np.int32), (rows @ (latent / size[:, None]).T).astype(np.float32), size.astype(np.float32))


class Finder:
    def __init__(self, idf: np.ndarray, space: Space):
        self.passages, self.place, self.rows, self.size = space
        self.square = (idf.astype(np.float64) ** 2)

    def candidates(self, h: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, window, passage, cosine) of a stretch of texts."""
        n = np.diff(cut)
        halves = -(-n // HALF)
        first = np.concatenate([[0], np.cumsum(halves)])
        if not len(h):
            return
        text = np.repeat(np.arange(len(n)), n)
        half = first[text] + (np.arange(len(h)) - cut[text]) // HALF
        at = features(h)
        square = np.bincount(half, self.square[at], minlength=first[-1])
        row = self.place[at]
        known = np.flatnonzero(row >= 0)
        mass = np.zeros((first[-1], self.rows.shape[1]), np.float32)
        if len(known):
            owner = half[known]
            edge = np.flatnonzero(np.diff(owner, prepend=-1))
            mass[owner[edge]] = np.add.reduceat(self.rows[row[known]], edge, axis=0)
        owner = np.repeat(np.arange(len(n)), halves)             # text of each half; a window is a half and the next
        paired = np.flatnonzero(owner[:-1] == owner[1:])
        single = np.flatnonzero(halves[owner] == 1)
        at = np.concatenate([paired, single])
        seen = mass[at]
        norm = square[at]
        seen[:len(paired)] += mass[paired + 1]
        norm[:len(paired)] += square[paired + 1]
        norm = np.sqrt(np.maximum(norm, 1e-9)).astype(np.float32)
        w, p = np.nonzero((seen >= COSINE * norm[:, None]) | (seen >= COVERED * self.size))
        for a, b, c in zip(w.tolist(), p.tolist(), (seen[w, p] / norm[w]).tolist(), strict=True):
            x = at[a]
            yield int(owner[x]), int(x - first[owner[x]]), b, c

    def find(self, h: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, int, float, float, bool]]:
        """(text, item, cosine, share in order, answer) of each confirmed passage."""
        by: dict[tuple[int, int], list[tuple[int, float]]] = defaultdict(list)
        for text, window, p, c in self.candidates(h, cut):
            by[text, p].append((window, c))
        shown: dict[int, list[int]] = {}
        for (text, p), met in by.items():
            item, all_words = self.passages[p].words, shown.get(text)
            if all_words is None:
                all_words = shown[text] = h[cut[text]:cut[text + 1]].view(np.int64).tolist()
            met.sort()
            while met:                                           # windows near each other are read as one region
                run = [met.pop(0)]
                while met and (met[0][0] - run[0][0]) * HALF <= 2 * HALF + len(item):   # no long stretch meets an item by chance
                    run.append(met.pop(0))
                region = all_words[max(0, run[0][0] * HALF - len(item)):(run[-1][0] + 2) * HALF + len(item)]
                share = common_in_order(item, region) / len(item)
                answer = share >= REWORDED and answer_in(item, region)
                if share >= COPIED or answer:
                    yield text, self.passages[p].item, max(c for _, c in run), share, answer


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row."""
    out = h[:len(h) - n + 1]
    for k in range(1, n):
        out = mix(out) + h[k:len(h) - n + 1 + k]
    return out


class ShortFinder:
    """Finds items of few words where they stand word for word."""

    def __init__(self, passages: list[Passage]):
        self.items: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for p in passages:
            n = len(p.words)
            self.items[n][int(sequences(np.array(p.words, np.int64).view(np.uint64), n)[0])].add(p.item)

    def find(self, h: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, int, float, float, bool]]:
        text = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        for n, known in self.items.items():
            if len(h) < n:
                continue
            code = sequences(h, n)
            at = np.flatnonzero(np.isin(code, np.array(list(known), np.uint64)))
            at = at[text[at] == text[at + n - 1]]
            for t, c in set(zip(text[at].tolist(), code[at].tolist(), strict=True)):
                for item in known[c]:
                    yield t, item, 1.0, 1.0, True


_FOUND = "doc_id long, item_id long, cosine double, in_order double, answer boolean"


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, spaces, short = shared.value
        finders = [ShortFinder(short), *(Finder(idf, space) for space in spaces)]
        for b in batches:
            ids, out = b.column("doc_id").to_pylist(), []
            for at, h, cut in words(b.column("text").to_pylist()):
                out += [(ids[at + text], *rest) for finder in finders for text, *rest in finder.find(h, cut)]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()), strict=True)],
                names=["doc_id", "item_id", "cosine", "in_order", "answer"])
    return lean(run)


def _numbered(passages: DataFrame) -> DataFrame:
    """``passages`` with ``row`` (task and place in it) as numbers without gaps."""
    task = F.shiftright("row", 33)
    sizes = sorted(passages.groupBy(task.alias("task")).count().collect())               # a row a task
    firsts = np.cumsum([0] + [n for _, n in sizes]).tolist()
    start = F.create_map(*[F.lit(x) for (t, _), first in zip(sizes, firsts, strict=False) for x in (t, first)])
    return passages.withColumn("row", start[task] + F.expr("row & 8589934591"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, in_order, answer): which benchmark items stand in
    which documents, with the best evidence of each pair."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    passages = materialise(
        benchmark.select(F.col("item_id").cast("long"), text_or_empty().alias("text"))
        .mapInArrow(_passages, "item_id long, words array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "passages")
    total = passages.count()
    if not total:
        return spark.createDataFrame([], _FOUND)
    idf = inverse_frequencies(rows.select("text"))
    passages, found = _numbered(passages), None
    for block in range(0, total, BLOCK_ITEMS):
        spaces, short = [], []
        for first in range(block, min(total, block + BLOCK_ITEMS), RANK):
            upto = min(first + RANK, block + BLOCK_ITEMS)
            few = passages.where((F.col("row") >= first) & (F.col("row") < upto))
            held = [Passage(r.item_id, list(r.words)) for r in few.collect()]
            short += [p for p in held if len(p.words) < LEAST_WORDS]
            if long := [p for p in held if len(p.words) >= LEAST_WORDS]:
                spaces.append(space_of(long, idf, *latent_space(few.where(F.size("words") >= LEAST_WORDS), idf)))
        shared = share(spark, (idf, spaces, short))
        part = rows.mapInArrow(_find(shared), _FOUND)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("in_order", "cosine", "answer")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.cosine", "best.in_order", "best.answer")


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage."""
    keyed = docs.withColumn("__row", F.xxhash64(doc_key(), text_or_empty()))
    leaks = find_leaks(keyed.select(F.col("__row").alias("doc_id"), "text"), benchmark)
    leaks = materialise(leaks.select(F.col("doc_id").alias("__row")).distinct(), "leaks")
    return keyed.join(leaks, "__row", "left_anti").drop("__row")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))

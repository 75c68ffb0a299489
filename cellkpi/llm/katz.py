"""LM scoring with Katz backoff over distributed count tables.

Order two: the count of a word after a word is Good-Turing discounted, what the
discounts free goes to unseen words in proportion to the lower order, whose
counts are discounted alike down to one class of unknown words. Backoff weights are
exactly normalised: the freed mass over one minus the lower order's mass of
the words seen there. (Distinct pairs are half of these texts' tokens, distinct
triples 70 %, so a third order would store about the corpus again.)

Tasks pack the tokens of many texts into chunks. A chunk asks the partitioned tables
only for its distinct words, then for its distinct word pairs, and evaluates
each token from the answers: the pair's discounted count or, recursively, the
backoff weight times the lower order. Both tables are built by the tasks that answer: a
word belongs to a part by its hash, a pair by its first word. A first word with very many
pairs is spread over parts by the second one and its sums are added up for all;
at most ``SPLIT_WORDS`` words are that frequent. Requests are distinct within a
chunk, so a hot word or pair reaches its part once a chunk, not once a token.

Words are identified by 64-bit hashes (the chance that any two of a billion
words share one is below 3 %; such two would count as one word).

Defined cases: null or empty text is the end token alone; rows that repeat a
doc_id each count and are each scored; a null doc_id trains; a text's first
word follows an end; a discount that Good-Turing cannot give (no texts of some
count, or not between 0 and 1) is c / (c + 1); a word after which every count
exceeds ``K`` leaves one count of its total to unseen words; without training
texts every token has probability 1; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, materialise, table, text_or_empty
from cellkpi.llm.perfect_hash import mix

K = 5                        # counts above it are not discounted
CHUNK_TOKENS = 1 << 21
WORDS_A_PART = 1 << 19
PAIRS_A_PART = 1 << 20
SPLIT_WORDS = 1 << 16
END = b"\n"                  # no word has white space


# ----------------------------------------------------------------- the model

def discounts(spread: np.ndarray, k: int = K) -> np.ndarray:
    """Factor of each count 0..k+1 from ``spread`` (number of n-grams that occur
    1..k+1 times); the last stands for all larger counts."""
    n = np.concatenate([[0], np.asarray(spread, float)])
    out = np.arange(k + 2) / (np.arange(k + 2) + 1)
    out[k + 1] = 1.0
    if (n[1:k + 2] > 0).all() and (share := (k + 1) * n[k + 1] / n[1]) < 1:
        for r in range(1, k + 1):
            d = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
            if 0 < d < 1:
                out[r] = d
    return out


def spread_of(counts: np.ndarray, k: int = K) -> np.ndarray:
    return np.bincount(np.minimum(counts[counts > 0], k + 2), minlength=k + 3)[1:k + 2]


class Unigrams:
    """Lower order: probability of a word from its count; unknown words are one class."""

    def __init__(self, tokens: int, words: int, spread: np.ndarray):
        self.tokens, self.words, self.factor = tokens, words, discounts(spread)
        small = np.arange(1, K + 1)
        kept = tokens - ((1 - self.factor[1:K + 1]) * small * spread[:K]).sum()
        self.total = tokens if spread[:K].sum() else tokens + 1         # nothing discounted: one count for the unknown
        self.unknown = 1 - kept / self.total if tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        p = self.factor[np.minimum(counts, K + 1)] * counts / max(1, self.total)
        return np.where(counts > 0, p, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of add-one smoothing."""
        return np.log10((counts + 1) / (self.tokens + self.words + 1))


def backoff(totals: np.ndarray, small: np.ndarray, large: np.ndarray, lower: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, weight) of contexts with ``totals`` occurrences: ``small`` has the
    number of followers of each count 1..K, ``large`` the sum of counts above, ``lower``
    the lower order's mass of all followers."""
    divisor = totals + (small.sum(axis=1) == 0)
    kept = (small * (factor[1:K + 1] * np.arange(1, K + 1))).sum(axis=1) + large
    known = totals > 0
    divisor = np.where(known, divisor, 1)
    return divisor, np.where(known, (1 - kept / divisor) / (1 - lower), 1.0)


# ----------------------------------------------------------- packed integers

def pack(a: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    a = np.ascontiguousarray(a, np.uint64)
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    planes = a.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view(np.int64).ravel()


# -------------------------------------------------------------------- chunks

class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


_CHUNK = ("chunk long, tokens long, trained long, words long, hashes binary, counts binary, stream binary, "
          "sizes binary, ids array<long>, held array<boolean>")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chunk_row(chunk: int, words: _Words, parts: list[np.ndarray], ids: list, held: list[bool]) -> pa.RecordBatch:
    stream, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
    trained = np.repeat(~np.array(held), sizes)
    counts = np.bincount(stream[trained], minlength=len(words))
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    cells = [[chunk], [len(stream)], [int(trained.sum())], [len(words)], [hashes.tobytes()], [pack(counts)], [pack(stream)], [pack(sizes)], [ids], [held]]
    kinds = [pa.int64()] * 4 + [pa.binary()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.bool_())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=_names(_CHUNK))


def _encode(chunk_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        words, parts, ids, held, size = _Words({END: 0}), [], [], [], 0
        for b in batches:
            for text, doc, out in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), strict=True):
                tokens = text.lower().split()                # of bytes: ASCII letters and ASCII white space
                tokens.append(END)
                parts.append(np.fromiter(map(words.__getitem__, tokens), np.uint32, len(tokens)))
                ids.append(doc)
                held.append(out)
                size += len(tokens)
                if size >= chunk_tokens:
                    yield _chunk_row(chunk, words, parts, ids, held)
                    words, parts, ids, held, size, chunk = _Words({END: 0}), [], [], [], 0, chunk + 1
        if parts:
            yield _chunk_row(chunk, words, parts, ids, held)
    return run


# --------------------------------------------------------------------- words

_ASKED = "part long, chunk long, at binary, hashes binary, counts binary"
_TOLD = "part long, chunk long, at binary, codes binary, counts binary, spread array<long>"


def _ask_words(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                hashes, counts = np.frombuffer(b.column("hashes")[i].as_py(), np.uint64), unpack(b.column("counts")[i].as_py())
                part, rows = (hashes % np.uint64(parts)).astype(np.int64), []
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
                for mine in np.split(order, cuts[1:]):
                    rows.append((int(part[mine[0]]), b.column("chunk")[i].as_py(), pack(np.diff(mine, prepend=0)), hashes[mine].tobytes(), pack(counts[mine])))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_names(_ASKED))
    return run


def _tell_words(parts: int):
    """One part of the word table: its own row (no chunk) and the answer to each
    chunk, with a code for each word (small where it is frequent)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        part = int(rows.part.iloc[0])
        hashes = np.concatenate([np.frombuffer(h, np.uint64) for h in rows.hashes])
        words, place = np.unique(hashes, return_inverse=True)
        counts = np.bincount(place, np.concatenate([unpack(c) for c in rows["counts"]])).astype(np.int64)
        code = np.empty(len(words), np.int64)
        code[np.argsort(-counts, kind="stable")] = np.arange(len(words)) * parts + part
        seen = counts > 0
        out = [(part, None, b"", words[seen].tobytes(), pack(counts[seen]), [int(seen.sum()), *spread_of(counts).tolist()])]
        ends = np.cumsum([len(h) // 8 for h in rows.hashes])
        for chunk, at, i, j in zip(rows.chunk, rows["at"], [0, *ends[:-1]], ends, strict=True):
            mine = place[i:j]
            out.append((part, chunk, at, pack(code[mine]), pack(counts[mine]), None))
        return pd.DataFrame(out, columns=_names(_TOLD))
    return run


# --------------------------------------------------------------------- pairs

class _Chunk:
    """A chunk with its words' codes and counts, and its distinct pairs by part."""

    def __init__(self, row, words: pd.DataFrame, parts: int, split_from: float):
        n = int(row.words)
        self.count, code = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for at, codes, counts in zip(words["at"], words.codes, words["counts"], strict=True):
            place = np.cumsum(unpack(at))
            code[place], self.count[place] = unpack(codes), unpack(counts)
        self.code, self.sizes = code, unpack(row.sizes)
        self.stream = unpack(row.stream)
        self.trained = np.repeat(~np.array(row.held, bool), self.sizes)
        before = np.concatenate([[0], self.stream[:-1]])                       # 0 is the end token
        pairs, self.pair = np.unique(before * n + self.stream, return_inverse=True)
        self.first, self.second = pairs // n, pairs % n
        self.split = self.count > split_from                                   # of a word
        spread = np.maximum(1, np.ceil(self.count / split_from)).astype(np.uint64)[self.first]
        salt = np.where(self.split[self.first], mix(code[self.second]) % spread, np.uint64(0))
        self.part = (mix(mix(code[self.first]) + salt) % np.uint64(parts)).astype(np.int64)
        self.order = np.argsort(self.part, kind="stable")

    def by_part(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(part, its pairs, where the runs of equal first words begin among them)."""
        cuts = np.flatnonzero(np.diff(self.part[self.order], prepend=-1))
        for mine in np.split(self.order, cuts[1:]):
            if len(mine):
                yield int(self.part[mine[0]]), mine, np.flatnonzero(np.diff(self.first[mine], prepend=-1))


_PAIRS = "part long, chunk long, firsts binary, runs binary, seconds binary, n binary, counts binary"
_FOUND = "part long, chunk long, n binary, small binary, large binary, lower binary, spread array<long>, split array<long>, split_sums array<double>"


def _ask_pairs(parts: int, split_from: float):
    def run(chunk: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in chunk.itertuples():
            c = _Chunk(row, words, parts, split_from)
            n = np.bincount(c.pair[c.trained], minlength=len(c.first))
            for part, mine, runs in c.by_part():
                first = c.first[mine[runs]]
                out.append((part, row.chunk, pack(2 * c.code[first] + c.split[first]), pack(np.diff(runs, append=len(mine))),
                            pack(c.code[c.second[mine]]), pack(n[mine]), pack(c.count[c.second[mine]])))
        return pd.DataFrame(out, columns=_names(_PAIRS))
    return run


def _tell_pairs(unigrams):
    """One part of the pair table: the answer to each chunk (the count of each pair,
    the sums of each first word), and on a row without chunk the table itself
    and the sums of first words that have pairs in other parts too."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        firsts, runs = [unpack(x) for x in rows.firsts], [unpack(x) for x in rows.runs]
        words, run_of = np.unique(np.concatenate(firsts), return_inverse=True)
        first = np.repeat(run_of, np.concatenate(runs))
        second = np.concatenate([unpack(x) for x in rows.seconds])
        width = int(second.max()) + 1
        if len(words) * width >= 1 << 63:
            raise ValueError("too many words for one part")
        pairs, at, place = np.unique(first * width + second, return_index=True, return_inverse=True)
        n = np.bincount(place, np.concatenate([unpack(x) for x in rows.n])).astype(np.int64)
        seen = n > 0
        of, n_seen = (pairs // width)[seen], n[seen]
        lower = unigrams.value.probability(np.concatenate([unpack(x) for x in rows["counts"]])[at[seen]])
        small = np.bincount(of * (K + 1) + np.minimum(n_seen, K + 1) - 1, minlength=len(words) * (K + 1)).reshape(-1, K + 1)[:, :K]
        large = np.bincount(of, np.where(n_seen > K, n_seen, 0), minlength=len(words)).astype(np.int64)
        lower = np.bincount(of, lower, minlength=len(words))
        hot = np.flatnonzero(words & 1)
        sums = np.column_stack([small[hot], large[hot], lower[hot]]).astype(float)
        table_ = (int(rows.part.iloc[0]), None, pack(n_seen), pack(words[of] >> 1), pack((pairs % width)[seen]), b"",
                  spread_of(n).tolist(), (words[hot] >> 1).tolist(), sums.ravel().tolist())
        out, i, r = [table_], 0, 0
        for chunk, mine in zip(rows.chunk, runs, strict=True):
            words_, size = run_of[r:r + len(mine)], int(mine.sum())
            out.append((table_[0], chunk, pack(n[place[i:i + size]]), pack(small[words_].ravel()), pack(large[words_]), lower[words_].tobytes(), None, None, None))
            i, r = i + size, r + len(mine)
        return pd.DataFrame(out, columns=_names(_FOUND))
    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _evaluate(parts: int, split_from: float, model):
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        unigrams, factor, hot_words, hot_sums = model.value
        for row in chunk.itertuples():
            c = _Chunk(row, told[told.codes.notna()], parts, split_from)
            answers = {r.part: r for r in told[told.codes.isna()].itertuples()}
            n, weight, divisor = np.zeros(len(c.first), np.int64), np.ones(len(c.first)), np.ones(len(c.first))
            for part, mine, runs in c.by_part():
                a = answers[part]
                n[mine] = unpack(a.n)
                small, large, lower = unpack(a.small).reshape(-1, K), unpack(a.large), np.frombuffer(a.lower, float).copy()
                first = c.first[mine[runs]]
                wide = c.split[first]
                sums = hot_sums[np.searchsorted(hot_words, c.code[first[wide]])]
                small[wide], large[wide], lower[wide] = sums[:, :K], sums[:, K], sums[:, K + 1]
                d, w = backoff(c.count[first], small, large, lower, factor)
                size = np.diff(runs, append=len(mine))
                divisor[mine], weight[mine] = np.repeat(d, size), np.repeat(w, size)
            p = np.where(n > 0, factor[np.minimum(n, K + 1)] * n / divisor, weight * unigrams.probability(c.count[c.second]))
            starts = np.cumsum(c.sizes) - c.sizes
            total = lambda x: np.add.reduceat(x, starts)
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(row.ids), "Int64"), "held_out": np.array(row.held, bool), "n_tokens": c.sizes,
                "n_known": total((c.count > 0)[c.stream].astype(np.int64)), "base_score": total(unigrams.base(c.count)[c.stream]),
                "score": total(np.log10(p)[c.pair])}))
        return pd.concat(out) if out else pd.DataFrame(columns=_names(_SCORES))
    return run


# --------------------------------------------------------------------- plans

def score_documents(docs: DataFrame, held_out: Column, chunk_tokens: int = CHUNK_TOKENS, words_a_part: int = WORDS_A_PART,
                    pairs_a_part: int = PAIRS_A_PART, split_words: int = SPLIT_WORDS) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts, the add-one unigram
    score and the model's log10 probability, learnt from the rows not held out."""
    spark = docs.sparkSession
    arrow_batches(spark)
    chunks = materialise(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
                         .mapInArrow(_encode(chunk_tokens), _CHUNK), "lm-chunks")
    tokens, trained, words = chunks.agg(F.sum("tokens"), F.sum("trained"), F.sum("words")).first()
    tokens, trained, words = tokens or 0, trained or 0, words or 0

    arrow_batches(spark, 4)                              # a row is a chunk
    parts = -(-words // words_a_part) or 1
    told = materialise(chunks.select("chunk", "hashes", "counts").mapInArrow(_ask_words(parts), _ASKED)
                       .groupBy("part").applyInPandas(_tell_words(parts), _TOLD), "lm-words")
    spreads = told.where("chunk IS NULL").agg(*[F.sum(F.col("spread")[i]) for i in range(K + 2)]).first()
    known, *spread = (x or 0 for x in spreads)
    unigrams = Unigrams(trained, known, np.array(spread))
    told = told.where("chunk IS NOT NULL")

    parts = -(-tokens // pairs_a_part) or 1
    limits = parts, max(trained / split_words, pairs_a_part / 4)
    body = chunks.select("chunk", "words", "stream", "sizes", "held")
    pairs = (body.groupBy("chunk").cogroup(told.select("chunk", "at", "codes", "counts").groupBy("chunk"))
             .applyInPandas(_ask_pairs(*limits), _PAIRS))
    found = materialise(pairs.groupBy("part").applyInPandas(_tell_pairs(spark.sparkContext.broadcast(unigrams)), _FOUND), "lm-pairs")
    own = found.where("chunk IS NULL")
    spread = own.agg(*[F.sum(F.col("spread")[i]) for i in range(K + 1)]).first()
    width = K + 2
    hot = (own.select(F.posexplode("split").alias("i", "word"), "split_sums")
           .groupBy("word").agg(*[F.sum(F.col("split_sums")[F.col("i") * width + j]).alias(f"s{j}") for j in range(width)])
           .orderBy("word").collect())                   # split_words rows at most
    model = spark.sparkContext.broadcast((unigrams, discounts(np.array([x or 0 for x in spread])), np.array([r[0] for r in hot], np.int64),
                                          np.array([r[1:] for r in hot], float).reshape(len(hot), width)))
    answers = (told.select("chunk", "part", "at", "codes", "counts")
               .unionByName(found.where("chunk IS NOT NULL").select("chunk", "part", "n", "small", "large", "lower"), allowMissingColumns=True))
    arrow_batches(spark)
    scored = (chunks.select("chunk", "words", "stream", "sizes", "ids", "held").groupBy("chunk").cogroup(answers.groupBy("chunk"))
              .applyInPandas(_evaluate(*limits, model), _SCORES))
    return scored.withColumn("train_tokens", F.lit(trained).cast("long"))


def op13_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return (score_documents(docs, out)
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))

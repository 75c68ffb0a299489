"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton of a bounded labelled sample is built.
A text is parsed greedily into the longest pieces that occur in the sample;
few pieces mean few bits, pieces * log2(sample length), and the language with
the fewest bits wins. Texts are read as the UTF-8 bytes of their lower-cased letters,
with one gap for whatever stands between letters: every script keeps all its
letters, and a letter that a sample lacks costs a piece for each of its bytes.
Automata become dense transition tables, so a worker parses thousands of text
blocks in step with numpy; whole texts are covered (a piece ends at a block
border in every language alike).

Bounds of the sample (parameters): ``TRAIN_DOCS`` different texts of each
language (the smallest hash of each of as many residue classes, so one small
aggregate finds them), and of these an equal share each of ``TRAIN_CHARS`` code points
(short texts leave theirs to the others); it is all that is collected.

Defined cases: null text or no letter gives ``und`` with score 0; so does an
empty training set; equal bits go to the language first by name; null labels
teach nothing; rows are independent; input columns named like the results
are replaced.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, held_out, lean, share, table, with_schema, worker_state

TRAIN_DOCS = 64
TRAIN_CHARS = 20_000
BLOCK = 256                  # bytes parsed in step
STRIPE = 4096                # blocks in step
SHARPNESS = 20.0             # score: 1 / sum of 2 ** -(SHARPNESS * share of bits above the winner's)
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = 0                   # a byte that no sample has


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def letter_bytes(text: str) -> np.ndarray:
    """UTF-8 bytes of the lower-cased letters; whatever stands between letters is one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    shown = np.where(_is_letter()[points], points, 32).astype(np.uint32)
    raw = np.frombuffer(shown.tobytes().decode("utf-32-le").encode(), np.uint8)
    keep = raw != 32
    keep[1:] |= raw[:-1] != 32
    return raw[keep]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of each state (state 0 is the root)."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class CrossParser:
    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        shown = [letter_bytes(samples[name]) for name in self.languages]
        used = np.unique(np.concatenate([*shown, np.array([32], np.uint8)]))
        self._code = np.zeros(256, np.uint8)
        self._code[used] = np.arange(1, len(used) + 1)
        self._pad, self._codes = len(used) + 1, len(used) + 2
        moves = [suffix_automaton(self._code[x].tolist()) for x in shown]
        wide = sum(map(len, moves)) * self._codes >= 1 << 30
        self._kind, self._flag = (np.int64, 62) if wide else (np.int32, 30)      # bit of a transition that begins a piece
        base = np.cumsum([0, *map(len, moves)])
        self._roots = (base[:-1] * self._codes).tolist()
        self._moves = np.concatenate([self._table(m, int(b)) for m, b in zip(moves, base, strict=False)]).ravel() if moves else np.zeros(0, self._kind)
        self.bits = np.array([np.log2(max(2, len(x))) for x in shown])

    def codes(self, text: str) -> np.ndarray:
        return self._code[letter_bytes(text)]

    def _table(self, moves: list[dict[int, int]], base: int) -> np.ndarray:
        """Next state times the number of codes for each state and code. Where the
        piece ends (and always at the root), the state after a new piece's first byte,
        with the flag; a byte that the sample lacks is a piece by itself."""
        fresh = np.full(self._codes, base * self._codes, self._kind)
        for c, to in moves[0].items():
            fresh[c] = (base + to) * self._codes
        out = np.tile(fresh | self._kind(1 << self._flag), (len(moves), 1))
        for state, known in enumerate(moves[1:], 1):
            for c, to in known.items():
                out[state, c] = (base + to) * self._codes
        out[:, self._pad] = base * self._codes
        return out

    def pieces(self, texts: list[str]) -> np.ndarray:
        """Number of pieces of each text (rows) in each language (columns)."""
        coded = [self.codes(t) for t in texts]
        blocks = np.array([-(-len(c) // BLOCK) for c in coded], np.int64)
        flat = np.full(int(blocks.sum()) * BLOCK, self._pad, np.uint8)
        at = np.concatenate([[0], np.cumsum(blocks)])
        for c, a in zip(coded, at[:-1] * BLOCK, strict=True):
            flat[a:a + len(c)] = c
        flat = flat.reshape(-1, BLOCK)
        found = np.zeros((len(flat), len(self.languages)), np.int64)
        for a in range(0, len(flat), STRIPE):
            steps = np.ascontiguousarray(flat[a:a + STRIPE].T).astype(self._kind)
            for k, root in enumerate(self._roots):
                found[a:a + STRIPE, k] = self._parse(steps, root)
        running = np.concatenate([np.zeros((1, len(self.languages)), np.int64), np.cumsum(found, axis=0)])
        return running[at[1:]] - running[at[:-1]]

    def _parse(self, steps: np.ndarray, root: int) -> np.ndarray:
        """Pieces of each column of ``steps`` (bytes in rows)."""
        state = np.full(steps.shape[1], root, self._kind)
        count, mask = np.zeros(steps.shape[1], np.int32), self._kind((1 << self._flag) - 1)
        for codes in steps:
            state += codes
            state = self._moves.take(state)
            count += (state >> self._flag).astype(np.int32)
            state &= mask
        return count

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        shown = [t if t is not None and _LETTER.search(t) else None for t in texts]
        names = np.array([UNKNOWN] * len(texts), object)
        score = np.zeros(len(texts))
        known = [i for i, t in enumerate(shown) if t is not None]
        if self.languages and known:
            bits = self.pieces([shown[i] for i in known]) * self.bits
            best = bits.argmin(axis=1)
            names[known] = np.array(self.languages, object)[best]
            over = bits / np.maximum(bits.min(axis=1, keepdims=True), 1) - 1        # share of bits above the winner's
            score[known] = 1 / np.exp2(-SHARPNESS * over).sum(axis=1)
        return names.tolist(), score


def training_sample(labelled: DataFrame, docs_per_language: int = TRAIN_DOCS,
                    chars: int = TRAIN_CHARS) -> dict[str, str]:
    """Text of each language from rows (text, lang), bounded by the parameters."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    picked = (rows.groupBy("lang", F.expr(f"pmod(h, {docs_per_language})")).agg(F.min("h").alias("h"))
              .collect())                            # docs_per_language hashes a language
    if not picked:
        return {}
    texts = (rows.where(F.col("h").isin(sorted({r.h for r in picked})))
             .groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h").collect())
    wanted, by_lang = {(r.lang, r.h) for r in picked}, {}
    for r in texts:
        if (r.lang, r.h) in wanted:
            by_lang.setdefault(r.lang, []).append(r.text)
    out = {lang: _shares(found, chars) for lang, found in by_lang.items()}
    return {lang: text for lang, text in out.items() if text}


def _shares(texts: list[str], chars: int) -> str:
    """Beginnings of all texts, of equal length where they are long enough."""
    parts, left = [], chars
    for i, t in enumerate(sorted(texts, key=len)):
        parts.append(t[:max(0, left // (len(texts) - i))])
        left -= len(parts[-1]) + 1
    return " ".join(parts)[:chars].lstrip()


def _identify(samples, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_state(("language_id", samples.value), lambda: CrossParser(dict(samples.value)))
        for b in batches:
            langs, score = parser.predict(b.column("text").to_pylist())
            new = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(score)}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)
    return lean(run)


def identify_language(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score`` (1: no other language comes near)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    out = with_schema(docs, lang_pred="string", score="double")
    shared = share(spark, tuple(sorted(samples.items())))
    return docs.mapInArrow(_identify(shared, out.names), out)


def learn(docs: DataFrame) -> dict[str, str]:
    """Sample of the documents that are not held out."""
    return training_sample(docs.where(~held_out()))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_language(docs.select("doc_id", "text", held_out().alias("held_out")), learn(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")

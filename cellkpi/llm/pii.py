"""Personal data: rules, and a character BiLSTM-CRF that adds to them.

The rules find e-mail addresses, IP addresses, card and phone numbers. Labelled
spans (the rules' findings in a bounded sample, also rewritten into forms that
the rules do not know, among numbers that are none) train the tagger in numpy.
Every text is cut into overlapping windows, all windows are decoded, and the
windows' spans are reconciled over the whole text: spans cut by a window's edge
are joined with what the next window saw, and of overlapping spans the set with
the largest total length stays. Rule spans always stay; a tagger's span is
added if it touches none of them and has its kind's digits or sign.

Bound of the sample (parameter): ``TRAIN_WINDOWS`` windows of ``TRAIN_CHARS``
characters, in the order of their hashes; only those windows are collected.

Defined cases: null or empty text has no spans; without anything to learn from
only the rules speak; rows are independent; input columns named like the
results are replaced. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, table, text_or_empty, with_schema
from cellkpi.llm.pii_model import PAD, Decoder, Tagger, fit

KINDS = ("email", "ip", "card", "phone")
TRAIN_WINDOWS = 1200
TRAIN_CHARS = 64
ROUNDS, BATCH, RATE, SEED = 220, 96, 0.03, 11
WINDOW, OVERLAP = 256, 32
STRIPE = 2048                # windows decoded in step

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the run of local characters before each @ (from the last
    match on) and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield Span(start, 0, m.end())
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The rules' findings by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(Span(m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(Span(m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                    out.append(Span(m.start(), 3, m.end()))
    return sorted(out)


#: Classes of characters: 0 is padding; these signs have one each.
_SIGNS = "@.-_+()%:/, \n"
_CLASSES = 1 + len(_SIGNS) + 5


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of each code point: signs, digits, small and capital ASCII letters, other letters, the rest."""
    first = 1 + len(_SIGNS)
    out = np.full(0x110000, first + 4, np.uint8)
    for i in range(0x110000):
        if unicodedata.category(chr(i))[0] == "L":
            out[i] = first + 3
    out[ord("0"):ord("9") + 1], out[ord("a"):ord("z") + 1], out[ord("A"):ord("Z") + 1] = first, first + 1, first + 2
    for i, c in enumerate(_SIGNS):
        out[ord(c)] = 1 + i
    return out


def classes(text: str) -> np.ndarray:
    return _class_table()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]


# --- labelled windows ---------------------------------------------------------

def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, window, spans as start, kind, end) around the rules' findings of each
    text, and one window of each text from a place without any."""
    for b in batches:
        out = []
        for text in b.column("text").to_pylist():
            spans = base_spans(text)
            for s in spans:
                begin = max(0, s.start - xxhash.xxh64_intdigest(text[s.start:s.end], 1) % (TRAIN_CHARS // 2))
                out.append((begin, text, spans))
            out.append((xxhash.xxh64_intdigest(text[:TRAIN_CHARS], 2) % max(1, len(text)), text, spans))
        rows = []
        for begin, text, spans in out:
            shown = text[begin:begin + TRAIN_CHARS]
            inside = [[s.start - begin, s.kind, s.end - begin] for s in spans
                      if s.end > begin and s.start < begin + TRAIN_CHARS]
            rows.append({"h": xxhash.xxh64_intdigest(shown, 3) >> 1, "shown": shown,
                         "spans": [x for s in inside for x in s]})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("h", pa.int64()), ("shown", pa.string()), ("spans", pa.list_(pa.int32()))]))


def _rewritten(digits: str, rng: np.random.Generator, kind: int) -> str:
    if kind == 3:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return str(rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}"]))
    sep = str(rng.choice([" ", "-"]))
    return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))


def _varied(shown: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """The window with phone and card numbers in other forms and with numbers that are no personal data."""
    out, moved, at = "", [], 0
    for s in sorted(spans):
        if s.start < at or s.start < 0 or s.end > len(shown):
            return shown, spans
        out += shown[at:s.start]
        piece = shown[s.start:s.end]
        if s.kind >= 2:
            piece = _rewritten("".join(_DIGITS.findall(piece)), rng, s.kind)
        moved.append(Span(len(out), s.kind, len(out) + len(piece)))
        out, at = out + piece, s.end
    tail = shown[at:]
    if (gap := tail.find(" ")) >= 0:
        number = "".join(map(str, rng.integers(0, 10, int(rng.integers(1, 9)))))
        number = number[:2] + str(rng.choice(["", ".", ",", "-", ":"])) + number[2:]
        tail = tail[:gap + 1] + number + tail[gap:]
    return out + tail, moved


def labelled_windows(texts: DataFrame, windows: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags [windows, TRAIN_CHARS] from a bounded sample."""
    marked = texts.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(
        _windows, "h long, shown string, spans array<int>").where("shown <> ''")
    half = windows // 2
    # half of the windows with spans: the least hash of each of ``half`` residue classes
    rows = (marked.groupBy(F.expr("size(spans) > 0").alias("found"), F.expr(f"pmod(h, {half})").alias("r"))
            .agg(F.min(F.struct("h", "shown", "spans")).alias("s")).select("s.*").orderBy("h", "shown").collect())
    rng, made = np.random.default_rng(SEED), []
    for r in rows:
        spans = [Span(*r.spans[i:i + 3]) for i in range(0, len(r.spans), 3)]
        made += [(r.shown, spans), _varied(r.shown, spans, rng)]
    x, y = (np.zeros((len(made), TRAIN_CHARS), np.int64) for _ in range(2))
    for i, (shown, spans) in enumerate(made):
        c = classes(shown)[:TRAIN_CHARS]
        x[i, :len(c)] = c
        for s in spans:
            y[i, max(0, s.start):max(0, min(s.end, len(c)))] = s.kind + 1
    return x, y


def train(texts: DataFrame, windows: int = TRAIN_WINDOWS) -> Tagger | None:
    arrow_batches(texts.sparkSession)
    x, y = labelled_windows(texts, windows)
    return fit(x, y, _CLASSES, 1 + len(KINDS), ROUNDS, BATCH, RATE, SEED) if y.any() else None


# --- decoding -----------------------------------------------------------------

def _cut(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows [n, WINDOW] of all texts, with the text and first place of each."""
    step = WINDOW - OVERLAP
    counts = np.array([max(1, -(-(len(c) - OVERLAP) // step)) for c in codes])
    text = np.repeat(np.arange(len(codes)), counts)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
    flat = np.full((len(text), WINDOW), PAD, np.uint8)
    row = 0
    for c, n in zip(codes, counts.tolist(), strict=True):
        padded = np.full((n - 1) * step + WINDOW, PAD, np.uint8)
        padded[:len(c)] = c
        flat[row:row + n] = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]
        row += n
    return flat, text, first


def window_spans(decoder: Decoder, texts: list[str]) -> list[list[Span]]:
    """Spans of every window, in the texts' places; overlapping windows may differ."""
    out: list[list[Span]] = [[] for _ in texts]
    flat, text, first = _cut([classes(t) for t in texts])
    for a in range(0, len(flat), STRIPE):
        columns, tags = decoder.tags(np.ascontiguousarray(flat[a:a + STRIPE].T).astype(np.intp))
        for col, tag in zip((columns + a).tolist(), tags.T, strict=True):
            edge = np.flatnonzero(np.diff(tag, prepend=0, append=0))
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if tag[s]:
                    out[text[col]].append(Span(int(first[col]) + s, int(tag[s]) - 1, int(first[col]) + e))
    return out


def reconcile(spans: list[Span]) -> list[Span]:
    """One consistent set: spans of a kind that overlap or touch at a window's edge
    are joined; then the non-overlapping set of the largest total length."""
    joined: list[Span] = []
    for kind in range(len(KINDS)):
        for s in sorted(x for x in spans if x.kind == kind):
            if joined and joined[-1].kind == kind and s.start < joined[-1].end:
                joined[-1] = joined[-1]._replace(end=max(joined[-1].end, s.end))
            else:
                joined.append(s)
    joined.sort(key=lambda s: (s.end, s.start, s.kind))
    best: list[tuple[int, int, int]] = [(0, -1, 0)]              # (length so far, span taken, from which state)
    ends = [s.end for s in joined]
    for i, s in enumerate(joined):
        before = int(np.searchsorted(ends[:i], s.start, side="right"))
        take = best[before][0] + s.end - s.start
        best.append((take, i, before) if take > best[i][0] else (best[i][0], -1, i))
    out, at = [], len(joined)
    while at:
        _, taken, at = best[at]
        if taken >= 0:
            out.append(joined[taken])
    return sorted(out)


_SHAPES = (re.compile(r"\S+@\S+\.\S+"), re.compile(r"[0-9]{1,3}(?:[.:][0-9]{1,3}){3}"),
           re.compile(r"[0-9](?:[ ./-]{0,2}[0-9])+"),
           re.compile(r"(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"))


def plausible(text: str, s: Span) -> bool:
    """An added span has its kind's shape (a card: digits and separators; a phone: groups
    of digits), stands by itself, and its numbers hold: parts of an address up to 255, a
    card's checksum."""
    shown = text[s.start:s.end]
    if not _SHAPES[s.kind].fullmatch(shown) or text[s.end:s.end + 1].isalnum() or text[max(0, s.start - 1):s.start].isalnum():
        return False
    digits = "".join(_DIGITS.findall(shown))
    if s.kind == 1:
        return all(int(p) <= 255 for p in re.split("[.:]", shown))
    return 13 <= len(digits) <= 19 and luhn(digits) if s.kind == 2 else s.kind == 0 or 9 <= len(digits) <= 15


def add_spans(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    extra = [s for s in reconcile(found) if s.end <= len(text) and plausible(text, s)
             and not any(s.start < b.end and b.start < s.end for b in base)] if found else []
    return sorted(base + extra)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@lru_cache(maxsize=1)
def _decoder(parts: tuple[tuple[bytes, tuple[int, ...]], ...]) -> Decoder:
    return Decoder(Tagger(*(np.frombuffer(raw).reshape(shape) for raw, shape in parts)))


def _detect(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(model.value) if model.value else None
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            found = window_spans(decoder, texts) if decoder else [[] for _ in texts]
            every = [add_spans(t, s, f) for t, s, f in zip(texts, base, found, strict=True)]
            shown = lambda rows: pa.array([[{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in r] for r in rows], _SPANS)
            new = {"base": shown(base), "spans": shown(every)}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)
    return run


def find_personal_data(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``docs`` plus ``base`` (the rules' spans) and ``spans`` (all of them)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    kind = "array<struct<kind:string,start:int,end:int>>"
    out = with_schema(docs, base=kind, spans=kind)
    parts = tuple((np.asarray(p, float).tobytes(), p.shape) for p in model) if model else None
    return docs.mapInArrow(_detect(spark.sparkContext.broadcast(parts), out.names), out)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    found = find_personal_data(docs, train(docs)).drop("text")
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(shown("base").cast("binary"), 256).alias("base_sha256"), shown("spans").alias("spans"))

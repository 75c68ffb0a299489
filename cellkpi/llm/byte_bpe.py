"""Byte-level BPE encoding and decoding with the tokenizers library.

A text's UTF-8 bytes are written as printable characters (the byte table of
byte-level vocabularies), each match of the pre-token pattern is encoded by
the library's BPE model, and decoding reverses the table. Work is done over
Arrow batches. Space-led words recur, so each worker keeps a bounded cache of
word -> ids; a word is what lies between single spaces, and no pre-token
crosses such a border, so the ids are those of the whole text.

Defined cases: null or empty text has no ids, decodes to the empty string and
has empty offsets; other columns pass unchanged (``ids``, ``offsets``,
``decoded``, ``decoded_text`` of the input are replaced); rows are independent,
so repeated rows and ties need no rule.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from cellkpi.llm.common import arrow_batches, lean, share, table, with_schema, worker_state

CACHE_WORDS = 100_000        # per generation (a worker has two); the older one is dropped
CACHE_WORD_CHARS = 64        # longer words are encoded without the cache
#: The pattern whose pieces never cross a single space between other characters;
#: under any other pattern every text is split as a whole.
SPACED_PATTERN = public_tokenizers.PATTERN
#: Words of letters below this code point, with a full stop or comma or nothing
#: after them, are split without the pattern (same pieces).
LETTERS_BELOW = "\u0250"
_LOOSE_SPACE = re.compile(r" \s|\s ")
_STRICT_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_table() -> list[str]:
    """Character of each byte: visible Latin-1 bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def read_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines()) if token}


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair of lower-ranked tokens that each token is merged from, by rank."""
    pairs = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], rank))
            if ranks.get(parts[best] + parts[best + 1], rank) >= rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            pairs.append((parts[0], parts[1]))
    return pairs


class Codec:
    def __init__(self, blob: bytes, pattern: str):
        from tokenizers import models
        ranks = read_ranks(blob)
        chars = byte_table()
        self._to_char = {b: c for b, c in enumerate(chars)}
        self._to_byte = {ord(c): b for b, c in enumerate(chars)}
        shown = lambda token: "".join(chars[b] for b in token)
        self._model = models.BPE({shown(t): r for t, r in ranks.items()},
                                 [(shown(a), shown(b)) for a, b in merge_pairs(ranks)], ignore_merges=True)
        self._find = regex.compile(pattern).findall
        self._spaced = pattern == SPACED_PATTERN
        self._cache: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        size = max(ranks.values(), default=-1) + 1
        self.token_chars = [""] * size
        for t, r in ranks.items():
            self.token_chars[r] = shown(t)
        self.token_bytes = [self._bytes(c) for c in self.token_chars]
        self.token_length = np.array([len(b) for b in self.token_bytes], np.int64)

    def _bytes(self, chars: str) -> bytes:
        """Reverse the byte table."""
        return chars.translate(self._to_byte).encode("latin-1")

    def _pieces(self, text: str) -> bytes:
        """int32 ids of a text, each pattern match by itself."""
        ids: list[int] = []
        for piece in self._find(text):
            ids += self._piece(piece)
        return array("i", ids).tobytes()

    def _piece(self, piece: str) -> list[int]:
        shown = piece.encode().decode("latin-1").translate(self._to_char)
        return [t.id for t in self._model.tokenize(shown)]

    def _word(self, word: str) -> bytes:
        """Ids of a space and ``word`` (not in the younger cache)."""
        if (ids := self._older.get(word)) is not None:
            self._cache[word] = ids
            return ids
        plain = word[:-1] if word[-1:] in (".", ",") else word
        if plain.isalpha() and max(plain) < LETTERS_BELOW:
            ids = self._piece(" " + plain) + (self._piece(word[-1]) if plain != word else [])
            ids = array("i", ids).tobytes()
        else:
            ids = self._pieces(" " + word)
        if len(word) <= CACHE_WORD_CHARS:
            if len(self._cache) >= CACHE_WORDS:
                self._older, self._cache = self._cache, {}
            self._cache[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if not self._spaced:
            return np.frombuffer(self._pieces(text), np.int32)
        if _LOOSE_SPACE.search(text) or text[0] == " " or text[-1] == " ":
            words = _STRICT_SPACE.split(text)
        else:
            words = text.split(" ")
        out = [self._pieces(words[0])]
        for w in words[1:]:
            ids = self._cache.get(w)
            out.append(self._word(w) if ids is None else ids)
        return np.frombuffer(b"".join(out), np.int32)

    def byte_ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.token_length[ids])

    def offsets(self, text: str, ids: np.ndarray) -> np.ndarray:
        """[start, end) of each token in code points. A token that holds part of
        a character covers the whole character."""
        raw = np.frombuffer(text.encode(), np.uint8)
        starts_before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])    # characters begun before byte i
        ends = self.byte_ends(ids)
        begins = ends - self.token_length[ids]
        inside = (raw[begins] & 0xC0) == 0x80 if len(ids) else np.zeros(0, bool)
        return np.stack([starts_before[begins] - inside, starts_before[ends]], 1)

    def decode(self, ids) -> bytes:
        get = self.token_bytes.__getitem__
        return b"".join(map(get, ids.tolist() if isinstance(ids, np.ndarray) else ids))

    def decode_parts(self, ids) -> list[str]:
        """Text that each token completes: bytes of a split character wait for
        its last token; bytes that never make a character become U+FFFD."""
        held = codecs.getincrementaldecoder("utf-8")("replace")
        ids = list(ids)
        return [held.decode(self.token_bytes[x], final=i == len(ids) - 1) for i, x in enumerate(ids)]


    def parts_cover(self, raw: bytes, ids: np.ndarray, spans: np.ndarray) -> bool:
        """Whether decoding token by token gives, around each split character, the
        characters that the offsets name. Other tokens hold whole characters, whose
        bytes are the decoded bytes themselves."""
        shares = spans[1:, 0] < spans[:-1, 1]
        if not shares.any():
            return True
        text, inside = raw.decode("utf-8", "replace"), np.concatenate([[False], shares])
        starts = np.flatnonzero(~inside & np.concatenate([shares, [False]]))
        ends = np.flatnonzero(inside & ~np.concatenate([shares, [False]])) + 1
        return all("".join(self.decode_parts(ids[a:z].tolist())) == text[spans[a, 0]:spans[z - 1, 1]]
                   for a, z in zip(starts.tolist(), ends.tolist(), strict=True))


def codec(blob: bytes, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    return worker_state(("byte_bpe", hash(blob), pattern), lambda: Codec(blob, pattern))


def _vocabulary(spark: SparkSession, path: str | None, pattern: str | None):
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return share(spark, (f.read(), pattern or public_tokenizers.PATTERN))


def _lists(rows: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind) if not isinstance(kind, pa.StructType)
                                    else pa.StructArray.from_arrays(
                                        [pa.array(flat[:, i].astype(np.int32)) for i in range(2)], ["start", "end"]))


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _encode(vocabulary, offsets: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary.value)
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            ids = [c.encode(t) for t in texts]
            new = {"ids": _lists(ids, pa.int32())}
            if offsets:
                new["offsets"] = _lists([c.offsets(t, i).reshape(-1, 2) for t, i in zip(texts, ids, strict=True)], _SPAN)
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)
    return lean(run)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None,
                     offsets: bool = False) -> DataFrame:
    """``docs`` plus ``ids`` (array of int) and, if asked for, ``offsets``
    (array of start, end in code points)."""
    arrow_batches(docs.sparkSession)
    extra = {"ids": "array<int>"} | ({"offsets": "array<struct<start:int,end:int>>"} if offsets else {})
    out = with_schema(docs, **extra)
    return docs.mapInArrow(_encode(_vocabulary(docs.sparkSession, path, pattern), offsets, out.names), out)


def _id_rows(b: pa.RecordBatch) -> list[np.ndarray]:
    column = b.column("ids")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum([0, *(n or 0 for n in column.value_lengths().to_pylist())])
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def _decode(vocabulary, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary.value)
        for b in batches:
            raw = [c.decode(i) for i in _id_rows(b)]
            new = {"decoded": pa.array(raw, pa.binary()),
                   "decoded_text": pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)
    return lean(run)


def decode_documents(df: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` plus ``decoded`` (the bytes of its ``ids``) and ``decoded_text``
    (as text; bytes that make no character become U+FFFD)."""
    arrow_batches(df.sparkSession)
    out = with_schema(df, decoded="binary", decoded_text="string")
    return df.mapInArrow(_decode(_vocabulary(df.sparkSession, path, pattern), out.names), out)


def _digest(vocabulary, encoded: bool, offsets: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(*vocabulary.value)
        shown = list(map(str, range(len(c.token_bytes)))).__getitem__
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            texts = None if encoded else [t or "" for t in b.column("text").to_pylist()]
            rows = _id_rows(b) if encoded else [c.encode(t) for t in texts]
            raw = [c.decode(i) for i in rows]
            columns = [b.column("doc_id"), pa.array([len(i) for i in rows], pa.int64()),
                       pa.array([sha(" ".join(map(shown, i.tolist())).encode()) for i in rows], pa.string()),
                       pa.array([sha(x) for x in raw], pa.string())]
            if offsets:
                spans = [c.offsets(t, i) for t, i in zip(texts, rows, strict=True)]
                # Spans that overlap their predecessor's share a character with it.
                columns += [pa.array([sha(np.ascontiguousarray(s, "<i4").tobytes()) for s in spans], pa.string()),
                            pa.array([int((s[1:, 0] < s[:-1, 1]).sum()) for s in spans], pa.int64()),
                            pa.array([c.parts_cover(x, i, s) for x, i, s in zip(raw, rows, spans, strict=True)], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES[:len(columns)])
    return lean(run)


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_TRIPS = f"{_DIGESTS}, offsets_sha256 string, n_split long, parts_agree boolean"
_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "n_split", "parts_agree"]


def digests(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, number of ids, digest of the ids as decimal text and digest of
    the bytes they decode to."""
    return encoded.select("doc_id", "ids").mapInArrow(
        _digest(_vocabulary(encoded.sparkSession, path, pattern), True), _DIGESTS)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, offsets: bool = True) -> DataFrame:
    """The digests of encoded and decoded ``docs`` (doc_id, text) in one pass: one
    Python worker a task instead of one that encodes and one that decodes. Further
    columns with ``offsets``: ``offsets_sha256`` (of [start, end) of every token in code points, as
    little-endian 32-bit integers in order), ``n_split`` (tokens that begin inside a
    character) and ``parts_agree`` (decoding token by token, with split characters held
    until their last byte, gives the characters that the offsets name)."""
    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        _digest(_vocabulary(docs.sparkSession, path, pattern), False, offsets), _TRIPS if offsets else _DIGESTS)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs)

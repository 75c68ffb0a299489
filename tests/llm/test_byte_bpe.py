import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from cellkpi.llm.byte_bpe import Codec, decode_documents, digests, encode_documents, merge_pairs, read_ranks, round_trip


@pytest.fixture(scope="module")
def blob():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def codec(blob):
    return Codec(blob, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def judge(blob):
    return tiktoken.Encoding("judge", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(blob), special_tokens={})


def texts(n, seed):
    rng, signs = random.Random(seed), [*" \n\t  ab'sé日.,", "\x1c", "\U0001f600", "²", "٣", "<|endoftext|>", "Ñß", " the", "ing", "\r\n"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_ids_offsets_and_decoding(codec, judge):
    for text in texts(3000, 1):
        ids = codec.encode(text)
        assert ids.tolist() == judge.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        assert "".join(codec.decode_parts(ids)) == text
        spans = codec.offsets(text, ids)
        assert all(codec.token_bytes[i] in text[a:b].encode() for i, (a, b) in zip(ids, spans, strict=True))


def test_cache_generations(blob, judge, monkeypatch):
    monkeypatch.setattr("cellkpi.llm.byte_bpe.CACHE_WORDS", 5)
    small = Codec(blob, public_tokenizers.PATTERN)
    for text in [" ".join(f"w{i % 17}" for i in range(n)) for n in range(0, 80, 7)]:
        assert small.encode(text).tolist() == judge.encode_ordinary(text)


def test_parts_agree_with_offsets_around_split_characters(codec):
    split = 0
    for text in ["\U0001f9ff\U0001f9ffab", "日\U00020000語 x\U0001f6f8", *texts(300, 2)]:
        ids = codec.encode(text)
        spans = codec.offsets(text, ids).reshape(-1, 2)
        split += int((spans[1:, 0] < spans[:-1, 1]).sum())
        assert codec.parts_cover(text.encode(), ids, spans)
        if (spans[1:, 0] < spans[:-1, 1]).any():
            assert not codec.parts_cover(("z" * len(text)).encode(), ids, spans)
    assert split > 0


def test_split_character(codec):
    ids = [i for i, b in enumerate(codec.token_bytes) if b in (b"\xf0\x9f", b"\xf0", b"\x9f", b"\x98", b"\x80")]
    by = {codec.token_bytes[i]: i for i in ids}
    parts = codec.decode_parts([by[b"\xf0"], by[b"\x9f"], by[b"\x98"], by[b"\x80"]])
    assert parts == ["", "", "", "\U0001f600"]
    assert codec.decode_parts([by[b"\xf0"]]) == ["�"]


def test_other_vocabulary_and_pattern():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 257, b" a": 258}
    blob = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    assert merge_pairs(ranks) == [(b"a", b"b"), (b"ab", b"c"), (b" ", b"a")]
    assert Codec(blob, r"[^x]+|x").encode("ab cxabc a").tolist() == [256, 32, 99, 120, 257, 258]


def test_documents(odd_docs, no_docs, judge):
    out = decode_documents(encode_documents(odd_docs, offsets=True))
    for r in out.collect():
        assert r.ids == judge.encode_ordinary(r.text or "")
        assert r.decoded_text == (r.text or "") and bytes(r.decoded) == (r.text or "").encode()
        assert len(r.offsets) == len(r.ids)
    assert decode_documents(encode_documents(no_docs)).count() == 0


def test_digests(odd_docs, judge):
    parts = digests(encode_documents(odd_docs.select("doc_id", "text")).select("doc_id", "ids")).collect()
    trips = round_trip(odd_docs)
    assert sorted(map(str, parts)) == sorted(map(str, trips.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    spans = {r.text: b"".join(x.to_bytes(4, "little") for s in r.offsets for x in (s.start, s.end))
             for r in encode_documents(odd_docs.select("text"), offsets=True).collect()}
    assert {hashlib.sha256(x).hexdigest() for x in spans.values()} == {r.offsets_sha256 for r in trips.collect()}
    assert all(r.parts_agree for r in trips.collect())
    for r in parts:
        wanted = {x.doc_id: x.text or "" for x in odd_docs.collect()}[r.doc_id]
        ids = judge.encode_ordinary(wanted)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(wanted.encode()).hexdigest())

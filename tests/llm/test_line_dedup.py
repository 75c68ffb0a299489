import hashlib
from collections import defaultdict

import numpy as np
import pytest

from cellkpi.llm import line_dedup
from cellkpi.llm.line_dedup import dedup_lines
from cellkpi.llm.perfect_hash import LineArrays, PerfectHash


def plain(rows):
    """(doc_id, text) -> sorted (doc_id, kept text, lines, dropped)."""
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    big = (1 << 63) - 1
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(big if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= 2 and min(holders[key(x)]) != (big if doc is None else doc))]
        out.append((doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(-2**62, 2**62, (2, n))
    if n > 10:
        h1[:n // 2] = h1[0]                       # told apart by the second half only
    phf = PerfectHash.from_bytes(PerfectHash.build(h1, h2).to_bytes())
    assert sorted(phf.index(h1, h2)) == list(range(n))


def test_perfect_hash_wants_distinct_keys():
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1]), np.array([2, 2]))


def test_arrays_tell_foreign_keys():
    rng = np.random.default_rng(0)
    h1, h2, f1, f2 = rng.integers(-2**62, 2**62, (4, 5000))
    arrays = LineArrays.from_columns(**LineArrays.build(h1, h2, np.arange(5000) + 1, np.arange(5000)).columns())
    n, first = arrays.probe(h1, h2)
    assert (n == np.arange(5000) + 1).all() and (first == np.arange(5000)).all()
    assert (arrays.probe(f1, f2)[0] > 0).sum() == 0


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_odd_documents(odd_docs):
    out = dedup_lines(odd_docs)
    assert set(odd_docs.columns) | {"n_dropped"} == set(out.columns)
    assert got(out) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_empty_table(no_docs):
    assert dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("floor", [1, 5, 1024])
def test_hot_and_sharded_lines(spark, monkeypatch, floor):
    monkeypatch.setattr(line_dedup, "HOT_FLOOR", floor)
    rows = [(i, f"very common line\nline number {i % 7} x\nunique line {i:06d}\n  Very common LINE") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(dedup_lines(df, keys_per_shard=8)) == plain(rows)


def test_query_digests(spark, tmp):
    rows = [(1, "the same long line\na"), (2, "The same long line\nb"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    out = {r.doc_id: r for r in line_dedup.op1_line_dedup(spark, tmp).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [(out[i].n_lines, out[i].n_dropped, out[i].kept_sha256) for i in (1, 2, 3)] == [
        (2, 0, sha(rows[0][1])), (2, 1, sha("b")), (1, 0, sha(""))]


def test_a_shard_with_whole_keys_knows_no_others(monkeypatch):
    monkeypatch.setattr("cellkpi.llm.perfect_hash.fingerprint", lambda h1, h2: np.zeros(len(h1), np.uint32))
    rng = np.random.default_rng(5)
    h1, h2 = rng.integers(-2**63, 2**63 - 1, (2, 500))
    others = rng.integers(-2**63, 2**63 - 1, (2, 5000))
    n = np.full(500, 7)
    whole, short = (LineArrays.build(h1, h2, n, np.arange(500), w) for w in (True, False))
    assert (whole.probe(h1, h2)[0] == 7).all() and (whole.probe(h1, h2)[1] == np.arange(500)).all()
    assert not whole.probe(*others)[0].any() and short.probe(*others)[0].any()      # every print is alike here


def test_probes_stream_past_their_shard(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 3)
    monkeypatch.setattr(line_dedup, "arrow_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4"))
    rows = [(i, "\n".join(f"a line of number {(i * j) % 23}" for j in range(9)) + "\nfoot line of all") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for per_shard in (2, 10_000):
        got = dedup_lines(df, keys_per_shard=per_shard)
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == plain(rows)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellkpi.llm import topk_search as topk


def plain(rows, k=10):
    kept = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(1024 * x) for x in v]
            kept[i] = min(kept[i], w) if i in kept else w
    out = set()
    for q, v in kept.items():
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in kept.items() if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def search(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS score", "3 AS v")
    out = topk.top_k(topk.integer_vectors(df, F.col("embedding")), F.expr("vec_id % 100 = 0"), **more)
    return {(r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()}


@pytest.mark.parametrize("block", [7, 4096])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "SAMPLE", 20)
    monkeypatch.setattr(topk, "FIRST_CHUNK", 3)
    v = np.random.default_rng(3).normal(size=(320, 8)).astype(np.float32)
    v[50:150] = v[50]                                           # ties
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    assert search(spark, rows) == plain(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5, 9.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [-1.0, 0.0]), (7, [1.0]), (8, [0.0, 0.0]), (100, [0.0, 0.0])]
    assert search(spark, rows) == plain(rows)


def test_few_and_none(spark):
    assert search(spark, [(0, [1.0])]) == set()
    assert search(spark, []) == set()


def test_elimination_leaves_most_vectors_out():
    rng = np.random.default_rng(0)
    v = np.concatenate([c + rng.integers(-20, 20, (500, 6)) for c in rng.integers(-4000, 4000, (8, 6))])
    most = float((v.astype(float) ** 2).sum(1).max())
    space = topk.Space(6, most, topk.choose_pivots(v, most, 16), np.arange(0), v[:0])
    far, q = topk._distances(v, topk._lift(v, most), space), v[11]
    ids, scores, looked = topk.search(q, 11, topk._distances(q[None], np.zeros(1), space)[0], float((q ** 2).sum()), -np.inf, 10,
                                      v, np.arange(len(v)), far, most)
    order = topk.best(np.delete(v @ q, 11), np.delete(np.arange(len(v)), 11), 10)
    assert scores.tolist() == np.delete(v @ q, 11)[order].tolist() and looked < len(v) / 2


@pytest.mark.parametrize("size", [0.5, 300.0, 3e5])
def test_every_kind_of_number(spark, monkeypatch, size):
    """Sums of products within 2**24, 2**53 and beyond."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    v = np.random.default_rng(5).normal(size=(210, 6)).astype(np.float32) * size
    v[20:60] = v[20]
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    most = max(sum(math.floor(1024 * y) ** 2 for y in x) for _, x in rows)
    assert topk.exact_kind(most) == {0.5: np.float32, 300.0: np.float64, 3e5: np.int64}[size]
    assert search(spark, rows) == plain(rows)


def test_a_task_leaves_k_rows_a_query_for_all_its_blocks(monkeypatch):
    """Blocks are small integers on the way, and what a query finds in one block prunes the next."""
    rng = np.random.default_rng(2)
    v = rng.integers(-300, 300, (4 * 256, 16))
    most = float((v ** 2).sum(1).max())
    space = topk.Space(16, most, topk.choose_pivots(v, most, 8), np.arange(0), v[:0])
    shared = type("Shared", (), {"value": space})
    frame = lambda rows, block: topk.pd.DataFrame({"block": block, "vec_id": rows, "v": list(v[rows])})
    blocks = [topk._pack_candidates(shared)(frame(np.arange(i, i + 256), i)).iloc[0] for i in range(0, len(v), 256)]
    queries = topk._pack_queries(shared, 10)(frame(np.arange(50), 0)).iloc[0]
    assert len(blocks[0].vectors) == 256 * 16 * 2 and len(queries.q_vectors) == 50 * 16 * 2
    met = topk.pa.RecordBatch.from_pylist([{**b.to_dict(), **queries.drop("block", errors="ignore").to_dict()} for b in blocks])
    for held, wanted in ((topk.HELD, 500), (0, 500)):
        monkeypatch.setattr(topk, "HELD", held)
        found = [r for b in topk._search_blocks(shared, 10)(iter([met])) for r in b.to_pylist()]
        assert len(found) == wanted
        for q in range(50):
            scores = v @ v[q]
            order = [int(i) for i in topk.best(scores, np.arange(len(v)), 11) if i != q][:10]
            assert [r["vec_id"] for r in found if r["query_id"] == q] == order

import zlib
from collections import Counter, defaultdict

import pytest

from cellkpi.llm import sharding


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode())
        assert r.law == "bytes"
        by[r.shard].append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    return [sum(r["size"] for r in by[i]) for i in range(shards)]


def test_sizes_are_near_equal(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "repeat(string(id), 1 + cast(id % 50 AS int)) AS text")
    sizes = check(sharding.shard_documents(df, 8).collect(), 8)
    assert max(sizes) - min(sizes) < 0.04 * sum(sizes) / 8


def test_equal_texts_stay_together_unless_too_large(spark):
    small = spark.range(9_000).selectExpr("id AS doc_id", "'text ' || string(id div 3) AS text")
    parts = defaultdict(set)
    for r in sharding.shard_documents(small, 4).collect():
        parts[r.text].add(r.shard)
    assert max(map(len, parts.values())) == 1
    hot = small.unionByName(spark.range(9_000).selectExpr("0L AS doc_id", "'the very same text' AS text"))   # rows repeat, too
    sizes = check(sharding.shard_documents(hot, 4).collect(), 4)
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 4


def test_odd_documents(odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs, 3).collect()
    check(rows, 3)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd_docs.collect())
    assert sharding.shard_documents(no_docs, 8).count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_fewer_rows_than_shards(spark, n):
    rows = sharding.shard_documents(spark.range(n).selectExpr("id AS doc_id", "'t' AS text"), 8).collect()
    assert len(rows) == n


def test_main_path_is_native(spark, odd_docs):
    plan = sharding.shard_documents(odd_docs, 3)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_files(spark, tmp, odd_docs):
    sharding.write_shards(sharding.shard_documents(odd_docs.select("doc_id", "text"), 2), f"{tmp}/out")
    assert spark.read.parquet(f"{tmp}/out").count() == odd_docs.count()

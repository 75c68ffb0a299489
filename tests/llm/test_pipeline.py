"""The pipeline against plain versions of its stages, and its defined cases."""

import hashlib

import pytest
import tiktoken

import corpus_pipeline
from cellkpi.llm.common import table
from tests.llm.test_byte_bpe import read_ranks
from tests.llm.test_line_dedup import plain as plain_lines
from tests.llm.test_near_dup import plain as plain_groups

ITEM = "what is the name of the long river that flows through seven green valleys before it meets the sea answer the old amber river"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    words = "stone water light tree house field cloud road bird night table window letter garden summer winter".split()
    text = lambda i: " ".join(words[(i * 7 + k * (i % 5 + 1)) % 16] + str((i * k) % 11) for k in range(60))
    docs = [(i, text(i) + f"\nthis line stands in all of them\nown line of number {i} is here", "en", "s", None) for i in range(30)]
    docs += [(40 + i, text(3) + f" changed {i}", "en", "s", 1) for i in range(4)]
    docs += [(50, text(9) + " " + ITEM + " " + text(10), "en", "s", 1), (51, None, "en", "s", 1), (52, "123 456", None, None, None), (53, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, [d[:2] for d in docs]


def test_run_equals_plain_stages(spark, tables):
    import public_tokenizers
    at, rows = tables
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    rows = [(d, t) for d, t, *_ in plain_lines(rows)]
    kept = {d for d, _, c in plain_groups(rows) if d == c}
    rows = [(d, t) for d, t in rows if d in kept and ITEM not in t]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        judge = tiktoken.Encoding("judge", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    wanted = {(d, len(i := judge.encode_ordinary(t)), sha(" ".join(map(str, i)).encode()), sha(t.encode())) for d, t in rows}
    assert {tuple(r) for r in corpus_pipeline.run(spark, at).collect()} == wanted and len(wanted) > 20


def test_stages_keep_the_columns(spark, tables):
    at, _ = tables
    docs = table(spark, at, "documents").selectExpr("*", "1 AS shard", "2 AS score")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, at)
        assert docs.columns == corpus_pipeline.COLUMNS


def test_empty_documents(spark, tables, tmp):
    at, _ = tables
    table(spark, at, "documents").limit(0).write.parquet(f"{tmp}/documents.parquet")
    table(spark, at, "benchmark").write.parquet(f"{tmp}/benchmark.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0

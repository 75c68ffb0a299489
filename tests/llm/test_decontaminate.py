import random

import pytest

from cellkpi.llm import decontaminate as dec


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_in_order_by_table():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 25))] for _ in range(2))
        assert dec.common_in_order(a, b) == longest(a, b)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ta", "ri", "mo", "ne", "lu", "ska", "ber"]) for _ in range(rng.randint(1, 4)))
    items = [[word() for _ in range(rng.randint(15, 59))] for _ in range(40)] + [["too", "short"], []]
    docs, truth = [], set()
    for d in range(300):
        words = [word() for _ in range(rng.randint(20, 400))]
        if d % 3 == 0:
            i, at = rng.randrange(40), rng.randrange(len(words))
            copy = list(items[i])
            if d % 2:
                for k in rng.sample(range(len(copy) - dec.ANSWER), len(copy) // 8):       # reworded
                    copy[k] = word()
            words[at:at] = [w.upper() + "," if d % 9 == 0 else w for w in copy]
            truth.add((d, i))
        docs.append((d, " ".join(words)))
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
            spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"), truth)


@pytest.mark.parametrize("block", [4096, 15])
def test_planted_passages(corpus, monkeypatch, block):
    monkeypatch.setattr(dec, "BLOCK_ITEMS", block)
    docs, benchmark, truth = corpus
    rows = dec.find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == truth
    assert all(r.in_order >= dec.REWORDED for r in rows)


def test_only_clean_documents_stay(corpus):
    docs, benchmark, truth = corpus
    kept = dec.remove_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(300)) - {d for d, _ in truth}


def test_odd_documents(spark, odd_docs, no_docs):
    text = " ".join(f"word{i % 97}x{i % 13}" for i in range(500, 530))
    benchmark = spark.createDataFrame([(1, text), (1, text), (None, None), (2, ""), (3, "six short words are no proof")],
                                      "item_id long, text string")
    rows = dec.find_leaks(odd_docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(8, 1), (9, 1)} and len(rows) == 2
    assert sorted(str(r.doc_id) for r in dec.remove_leaks(odd_docs, benchmark).collect()) == sorted(
        str(r.doc_id) for r in odd_docs.collect() if r.doc_id not in (8, 9))
    assert dec.find_leaks(no_docs, benchmark).count() == 0
    assert dec.find_leaks(odd_docs, benchmark.limit(0)).count() == 0


def test_space_keeps_the_passages(corpus):
    docs, benchmark, _ = corpus
    passages = benchmark.select("item_id", "text").mapInArrow(dec._passages, "item_id long, words array<long>")
    import numpy as np
    idf = np.ones(dec.FEATURES, np.float32)
    place, basis = dec.latent_space(passages, idf)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-8)
    for r in passages.collect():
        row = np.zeros(len(basis))
        np.add.at(row, place[dec.features(np.array(r.words).view(np.uint64))], 1.0)
        assert np.linalg.norm(basis.T @ row) > 0.99 * np.linalg.norm(row)           # 40 passages, rank 40


@pytest.mark.parametrize("n", [1000, 4000])
def test_copies_of_a_large_benchmark(spark, n):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(8000)]
    items = [rng.choices(vocabulary, k=rng.randint(15, 59)) for _ in range(n)]
    docs, truth = [], set()
    for d in range(150):
        words = rng.choices(vocabulary, k=rng.randint(20, 200))
        if d % 3:
            i, at = rng.randrange(n), rng.randrange(len(words))
            words[at:at] = items[i]
            truth.add((d, i))
        docs.append((d, " ".join(words)))
    rows = dec.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                          spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in rows.collect()} == truth


@pytest.mark.parametrize("every", [3, 1])
def test_a_short_item_in_many_documents(spark, every):
    rng = random.Random(15)
    vocabulary = [f"w{i}" for i in range(6000)]
    items = [rng.choices(vocabulary, k=15), *(rng.choices(vocabulary, k=rng.randint(15, 59)) for _ in range(30))]
    docs, truth = [], set()
    for d in range(240):
        words = rng.choices(vocabulary, k=rng.randint(40, 200))
        if d % every == 0:
            at = rng.randrange(len(words))
            words[at:at] = items[0]
            truth.add((d, 0))
        docs.append((d, " ".join(words)))
    rows = dec.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                          spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in rows.collect()} == truth


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "机器学习模型需要大量数据才能得到可靠结果因此评测题目不应出现在训练文本之中"
    items = [(1, "What is photosynthesis?"), (2, chinese), (3, "天空为什么是蓝色"), (4, "yes"), (5, "?!")]
    docs = [(1, "what is Photosynthesis"), (2, "so what is photosynthesis, they asked"), (3, "what else is photosynthesis"),
            (4, "今天的新闻" + chinese + "明天再见"), (5, "孩子问天空为什么是蓝色的"), (6, "天空是蓝色"), (7, "yesterday"),
            (8, "what is"), (9, "photosynthesis"), (10, "Yes")]
    rows = dec.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1),
                          spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in rows.collect()} == {(1, 1), (2, 1), (4, 2), (5, 3), (10, 4)}

import random

import pytest

from cellkpi.llm import toxicity as tox
from cellkpi.llm.common import is_held_out


def best_parts(scores):
    """Maximal scoring segments by their definition: the best one, then left and right of it."""
    def of(a, z):
        top = max(((sum(scores[i:j + 1]), i, j) for i in range(a, z) for j in range(i, z)), default=(0, 0, 0), key=lambda x: x[0])
        return [] if top[0] <= 0 else [*of(a, top[1]), (top[1], top[2]), *of(top[2] + 1, z)]
    return of(0, len(scores))


def test_segments_are_all_maximal_ones():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(0, 14)
        listed = {i: rng.uniform(-2, 3) for i in range(n) if rng.random() < 0.6}
        found = tox.segments(sorted(listed.items()), 0.25)
        assert [(s.first, s.last) for s in found] == best_parts([listed.get(i, 0.0) - 0.25 for i in range(n)])


def test_lambda_solves_its_equation():
    shares = {0.0: 0.9, 2.0: 0.02, -1.0: 0.08}
    import math
    lam = tox._lambda(shares)
    assert abs(sum(p * math.exp(lam * (s - tox.DRIFT)) for s, p in shares.items()) - 1) < 1e-6


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(5, 60))]
        toxic = int(i % 6 == 0)
        if toxic:
            words[rng.randrange(len(words)):0] = ["vile", "Nasty!"] * rng.randint(1, 3)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + [(0, 1), (None, 1), (9999, None)], "doc_id long, toxic int"))


def test_held_out_accuracy_and_passages(corpus):
    docs, labels = corpus
    learn = labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2")
    out = tox.score_toxicity(docs, tox.train(docs, learn)).collect()
    asked = [r for r in out if is_held_out(r.doc_id)]
    assert len(asked) > 50 and all(r.predicted == (r.doc_id % 6 == 0) for r in asked)
    for r in out:
        assert all("vile" in r.text.lower()[p.start:p.end] or "nasty" in r.text.lower()[p.start:p.end] for p in r.passages)
        assert bool(r.passages) == (r.doc_id % 6 == 0) and 0 <= r.score <= 1


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 0), (4, 0), (5, 0), (7, 0)], "doc_id long, toxic int")
    model = tox.train(odd_docs, labels)
    out = tox.score_toxicity(odd_docs, model)
    assert out.count() == odd_docs.count() and {"score", "passages", "shard"} <= set(out.columns)
    empty = {r.score for r in out.where("text IS NULL OR text = ''").collect()}
    assert len(empty) == 1
    assert tox.score_toxicity(no_docs, model).count() == 0
    none = tox.train(no_docs, labels.limit(0))
    assert {r.score for r in tox.score_toxicity(odd_docs, none).collect()} == {0.0}


def test_whole_words_and_unspaced_scripts_are_read(spark):
    assert tox.tokens("Antisocial a1, \u4f60\u597d\u5417 x") == ["antis", "ocial", "a1", "\u4f60\u597d", "\u597d\u5417", "\u5417", "x"]
    rng, docs, labels = random.Random(8), [], []
    for i in range(500):
        toxic = int(i % 5 == 0)
        words = ["extra" + rng.choice(["gonal", "large", "fine"]) for _ in range(rng.randint(4, 30))]
        clause = "".join(rng.choice("\u5c71\u6c34\u4eba\u5929\u5730\u6728\u706b") for _ in range(rng.randint(5, 40)))
        if toxic and i % 2:
            words[rng.randrange(len(words)):0] = ["extravileness"] * 3
        elif toxic:
            k = rng.randrange(len(clause))
            clause = clause[:k] + "\u6076\u6bd2\u6076\u6bd2" + clause[k:]
        docs.append((i, " ".join(words) + " " + clause))
        labels.append((i, toxic))
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    learn = spark.createDataFrame(labels, "doc_id long, toxic int").where("crc32(cast(cast(doc_id AS string) AS binary)) % 4 <> 2")
    out = tox.score_toxicity(texts, tox.train(texts, learn)).collect()
    asked = [r for r in out if is_held_out(r.doc_id)]
    assert len(asked) > 80 and all(r.predicted == (r.doc_id % 5 == 0) for r in asked)

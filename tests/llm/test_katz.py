import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellkpi.llm import katz

SPACE = " \t\n\x0b\x0c\r"


def out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    words, lower = [""], {chr(c): chr(c + 32) for c in range(65, 91)}
    for c in text or "":
        if c in SPACE:
            words.append("")
        else:
            words[-1] += lower.get(c, c)
    return [w for w in words if w] + [None]                   # None: the end


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    """Katz backoff by dictionaries, one token at a time."""

    def __init__(self, texts):
        self.one, self.two, k = Counter(), Counter(), katz.K
        for t in texts:
            toks = tokens(t)
            self.one.update(toks)
            self.two.update(zip([None, *toks], toks, strict=False))
        self.n, self.after = sum(self.one.values()), {}
        for (v, w), c in self.two.items():
            self.after.setdefault(v, {})[w] = c
        self.d1, self.d2 = self.factors(self.one, k), self.factors(self.two, k)

    @staticmethod
    def factors(counts, k):
        n = Counter(counts.values())
        d = {r: r / (r + 1) for r in range(1, k + 1)}
        if all(n[r] for r in range(1, k + 2)) and (share := (k + 1) * n[k + 1] / n[1]) < 1:
            for r in d:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
                d[r] = x if 0 < x < 1 else d[r]
        return d

    def mass(self, counts, d, w):
        """(probability of a counted w, what is left to the others)."""
        total = sum(counts.values()) + all(c > katz.K for c in counts.values())
        return d.get(counts.get(w), 1) * counts.get(w, 0) / total, 1 - sum(d.get(c, 1) * c for c in counts.values()) / total

    def low(self, w):
        if not self.n:
            return 1.0
        p, left = self.mass(self.one, self.d1, w)
        return p if w in self.one else left

    def p(self, v, w):
        if v not in self.after:
            return self.low(w)
        p, left = self.mass(self.after[v], self.d2, w)
        return p if w in self.after[v] else left / (1 - sum(map(self.low, self.after[v]))) * self.low(w)

    def row(self, doc, text):
        toks = tokens(text)
        base = sum(math.log10((self.one[t] + 1) / (self.n + len(self.one) + 1)) for t in toks)
        score = sum(math.log10(self.p(v, w)) for v, w in zip([None, *toks], toks, strict=False))
        return doc, held(doc), len(toks), sum(t in self.one for t in toks), self.n, base, score


def check(spark, df, **kw):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    model = Plain([t for d, t in rows if not held(d)])
    wanted = sorted((model.row(*r) for r in rows), key=repr)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted(map(tuple, katz.score_documents(df, out(), **kw).select(names).collect()), key=repr)
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 6), round(r[6], 6))
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_odd_documents_equal_the_plain_model(spark, odd_docs):
    check(spark, odd_docs)


@pytest.mark.parametrize("kw", [{}, dict(chunk_tokens=200, words_a_part=30, pairs_a_part=100, split_words=5)])
def test_many_chunks_parts_and_hot_words(spark, kw):
    """A third of all tokens are one word, another third one pair."""
    dice = random.Random(2)
    words = [f"W{i}" for i in range(80)]
    texts = [" ".join(dice.choices(["the", "na na", *words], weights=[60, 40, *[1 + 40 // (i + 1) for i in range(80)]], k=dice.randrange(60))) for _ in range(150)]
    rows = [(dice.choice([None, *range(120)]), t) for t in texts] + [(7, None), (8, ""), (9, "na " * 500)]
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **kw)


def test_no_texts_and_no_training(spark, no_docs):
    assert katz.score_documents(no_docs, out()).count() == 0
    left_out = [i for i in range(100) if held(i)][:3]
    check(spark, spark.createDataFrame([(i, "some words") for i in left_out], "doc_id long, text string"))


def test_probabilities_after_any_word_sum_to_one():
    dice = np.random.default_rng(4)
    spread, counts = np.array([50, 20, 9, 5, 3, 2]), dice.integers(1, 40, 300)
    one = katz.Unigrams(int(counts.sum()), 300, katz.spread_of(counts))
    p1 = np.append(one.probability(counts), one.unknown)
    assert p1.sum() == pytest.approx(1)
    factor = katz.discounts(spread)
    for after in (dice.integers(0, 4, 300), dice.integers(0, 2, 300) * 9, np.ones(300, int)):
        after = np.append(after, 0)
        small = np.array([[(after == r).sum() for r in range(1, katz.K + 1)]])
        divisor, weight = katz.backoff(np.array([after.sum()]), small, np.array([after[after > katz.K].sum()]), np.array([p1[after > 0].sum()]), factor)
        p = np.where(after > 0, factor[np.minimum(after, katz.K + 1)] * after / divisor, weight * p1)
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_packed_integers():
    for a in ([], [0], [255, 256, 0], [1 << 62, 3]):
        assert katz.unpack(katz.pack(np.array(a, np.int64))).tolist() == a

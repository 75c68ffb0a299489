import random
import re

import numpy as np
import pytest

from cellkpi.llm import near_dup
from cellkpi.llm.components import components

BIG = (1 << 63) - 1


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words)} - {()} if len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def similar(a, b):
    both = len(a & b)
    return 100 * both >= 75 * (len(a) + len(b) - both)


def plain(rows):
    """(doc_id, size of the set, component) of each row, by all pairs."""
    ids, sets = [BIG if d is None else d for d, _ in rows], [shingles(t) for _, t in rows]
    up = list(range(len(rows)))
    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and similar(sets[i], sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(ids[i], least.get(root(i), BIG))
    return sorted((ids[i], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def family(rng, words, copies, edits, first):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10_000)}"
        out.append((first + i, " ".join(text)))
    return out


def got(df):
    return sorted((r.did, r.n, r.component) for r in near_dup.near_duplicates(df).collect())


def test_sets_and_signatures():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "B", "été", "x\ty", "É", "aa"]) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    sets, wanted = near_dup.shingle_sets([*texts, None, " \n"]), [*map(shingles, texts), set(), set()]
    assert [len(s) for s in sets] == [len(s) for s in wanted]
    assert all(len(np.intersect1d(sets[i], sets[j])) == len(wanted[i] & wanted[j]) for i in range(0, 150, 5) for j in range(i, 150, 7))
    rng2 = np.random.default_rng(0)
    a = np.unique(rng2.integers(0, 1 << 62, 900).astype(np.uint64))
    b = np.concatenate([a[:700], np.unique(rng2.integers(0, 1 << 62, 200).astype(np.uint64))])
    share = (near_dup.signature(a) == near_dup.signature(np.sort(b))).mean()
    assert abs(share - 700 / 1100) < 0.15


def test_odd_documents(odd_docs, no_docs):
    assert got(odd_docs) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert got(no_docs) == []


@pytest.mark.parametrize("cell", [1024, 8])
def test_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(near_dup, "CELL_NODES", cell)             # 8: parts of many cells, visitors and blocks
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 5)
    rng = random.Random(9)
    rows = [*family(rng, 60, 70, 7, 0), *family(rng, 12, 20, 2, 100), *family(rng, 300, 10, 30, 200), *family(rng, 30, 15, 0, 300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == plain(rows)


def test_one_of_each_group_stays(odd_docs):
    kept = near_dup.keep_one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = plain(sorted({(r.doc_id, r.text) for r in odd_docs.collect()}, key=str))
    assert sorted(BIG if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(d for d, _, c in rows if d == c)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    df = spark.createDataFrame([*edges, (5, 5), (None, 7), (1, 0), (0, 1)], "a long, b long")
    out = {r.node: r.root for r in components(df).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, **{200 + i: 200 for i in range(9)}}
    assert components(df.limit(0)).count() == 0

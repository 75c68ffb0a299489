import random
from collections import Counter
from itertools import permutations

import pytest

from cellkpi.llm import filter_audit as fa

MAX = (1 << 63) - 1
SPACE = " \t\n\x0b\x0c\r"


def plain(docs, labels):
    """Every order applied filter by filter to every document."""
    rows = []
    for doc, text, lang in docs:
        text, did, words = text or "", MAX if doc is None else doc, [""]
        for c in text:
            if c in SPACE:
                words.append("")
            else:
                words[-1] += c
        words = [w for w in words if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in text for c in "#$%&*|"),
                 "E": any((t or "") == text and (MAX if d is None else d) < did for d, t, _ in docs)}
        rows.append((lang or "", {f for f in fails if fails[f]}, any(i == doc is not None and q == 1 for i, q, _ in labels),
                     any(i == doc is not None and t == 1 for i, _, t in labels)))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            whole = left
            for k, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                out[part, order, k] = (len(left), len(gone), sum(f in r[1] for r in whole) - len(gone),
                                       sum(r[1] == {f} for r in whole), sum(r[2] for r in gone), sum(r[3] for r in gone))
    return {(p, o, k, *v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs, labels, **kw):
    return {tuple(r) for r in fa.audit_orders(fa.mask_counts(fa.failed_filters(docs, **kw), labels)).select(COLUMNS).collect()}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_documents_equal_the_plain_version(spark, odd_docs):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (8, 1, 1), (99, 1, 1)]
    docs = [(r.doc_id, r.text, r.lang) for r in odd_docs.collect()]
    assert audit(odd_docs, labels_of(spark, labels)) == plain(docs, labels)


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 20])
def test_copies_over_many_tasks_and_buckets(spark, bucket_bytes):
    dice = random.Random(5)
    words = ["red", "Blue", "GREEN", "a", "b#", "c", "x|y", "long" * 30]
    header = "the same long header " * 200
    texts = [header + " ".join(dice.choices(words, k=dice.randrange(60))) for _ in range(12)]
    texts += [" ".join(dice.choices(words, k=dice.randrange(400))) for _ in range(20)] + ["", header[:7], header]
    docs = [(dice.choice([None, *range(60)]), dice.choice(texts[:4] * 9 + texts), dice.choice(["en", "de", None])) for _ in range(160)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 60, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(7)
    assert audit(df, labels_of(spark, labels), bucket_bytes=bucket_bytes) == plain(docs, labels)


def test_empty_tables(spark, no_docs, odd_docs):
    assert audit(no_docs, labels_of(spark, [(1, 1, 1)])) == set()
    assert {r[7:9] for r in audit(odd_docs, labels_of(spark, []))} == {(0, 0)}


def test_trie_holds_whole_texts():
    trie, texts = fa.RadixTrie(), [b"", b"a", b"ab", b"abc", b"abd", b"b" * 5000 + b"x", b"b" * 5000, b"\xff\x00"]
    for i, t in enumerate(texts * 2):
        trie.insert(t, 100 - i, t)
    found = {rows[0]: (least, len(rows)) for least, rows in trie.terminals()}
    assert found == {t: (100 - i - len(texts), 2) for i, t in enumerate(texts)}


def test_ranges_follow_text_order_and_split_heavy_ones():
    sample = [(b"p" * 50 + bytes([97 + i % 26]) * 3, 10) for i in range(26)] + [(b"p" * 50, 4000)]
    ranges = fa.choose_ranges(sample, 40_000, 1000)
    order = sorted(t for t, _ in sample)
    firsts = [ranges.first[fa.bisect_right(ranges.prefixes, t)] for t in order]
    assert firsts == sorted(firsts) and max(ranges.buckets) > 10 and len(ranges.prefixes) >= 1
    assert all(len(p) <= 51 for p in ranges.prefixes)

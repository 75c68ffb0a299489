"""Toxic passages as maximum-scoring segments.

Tokens are pieces of words: five characters at a time, so inflected forms share their
stem and no part of a word goes unread; in scripts without spaces every two
neighbouring characters. Token weights are log-odds of toxic against clean text with an informative
Dirichlet prior (the pooled counts, once a document and over different texts); a weight counts only as far as it is
certain (two standard errors are taken off). A linear-time scan gives every
maximal scoring segment of a text. By extreme-value theory a segment of score
S in n tokens is worth lambda*S - ln(K*n): lambda solves sum p*exp(lambda*s)=1
over the clean tokens, K is fitted to the best segments of clean documents.
The worth of a text's significant segments, summed, goes through a logistic
curve fitted to labelled documents that had no part in the weights.

Bound of the sample (parameter): at most ``TRAIN_DOCS`` labelled documents, the smallest
hash of each of as many residue classes. Of these, three parts in four of the ids' second
hash make the weights and the fourth the curve. Collected are only tokens with
a weight (each needs at least ``MIN_TOXIC`` uses in the sample's toxic texts or
a significant lack of them) and one number a document.

Defined cases: null or empty text has no segments and gets the curve's value
at zero; a document labelled twice counts as toxic if either says so; null
labels teach nothing; without any training row every score is 0; input
columns named like the results are replaced; rows are independent.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellkpi.llm.common import arrow_batches, held_out, lean, materialise, share, table, text_or_empty, with_schema

TRAIN_DOCS = 32_768
PRIOR_SHARE = 0.02           # weight of the pooled prior, as a share of all counts
MIN_TOXIC = 3
CERTAIN = 2.5                # standard errors taken off a weight
DRIFT = 0.25                 # taken off every token, so that plain text scores below zero
SIGNIFICANT = 0.0            # least worth (nats over the chance level) of a passage
THRESHOLD = 0.3
PIECE = 5                    # characters of a word that make a token
#: Thai to Myanmar, kana, Han: scripts that put no spaces between words.
_UNSPACED = "\u0e00-\u109f\u3040-\u30ff\u3400-\u9fff"
_TOKEN = re.compile(rf"(?=([{_UNSPACED}]{{1,2}}|[^\W{_UNSPACED}]{{1,{PIECE}}}))(?:[{_UNSPACED}]|[^\W{_UNSPACED}]{{1,{PIECE}}})")
_EULER = 0.5772156649015329


class Segment(NamedTuple):
    first: int               # token positions, both included
    last: int
    score: float


class Model(NamedTuple):
    weights: dict[str, float]
    lam: float
    log_k: float
    slope: float
    level: float
    trained: bool


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def segments(scores: list[tuple[int, float]], drift: float) -> list[Segment]:
    """All maximal scoring segments of a text in which the tokens listed as
    (position, weight) have that weight and the others none, less ``drift`` a
    token: candidates are kept on a stack and each new positive token joins
    those it makes better, in time linear in the number of listed tokens."""
    stack: list[list[float]] = []          # [first, last, sum before, sum through]
    total, after = 0.0, 0
    for at, weight in scores:
        total -= drift * (at - after)
        after = at + 1
        before, total = total, total + weight - drift
        if total <= before:
            continue
        new = [at, at, before, total]
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= new[2]:
                k -= 1
            if k < 0 or stack[k][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[k][0], new[1], stack[k][2], new[3]]
            del stack[k:]
    return [Segment(int(a), int(z), through - before) for a, z, before, through in stack]


def worth(model: Model, text: str) -> tuple[float, float, list[tuple[Segment, float]]]:
    """(summed worth, lambda * best segment, significant segments with their worth)."""
    found = tokens(text)
    get = model.weights.get
    listed = [(i, w) for i, t in enumerate(found) if (w := get(t)) is not None]
    if not listed:
        return 0.0, 0.0, []
    level = model.log_k + math.log(len(found))
    every = segments(listed, DRIFT)
    kept = [(s, x) for s in every if (x := model.lam * s.score - level) > SIGNIFICANT]
    return sum(x for _, x in kept), model.lam * max((s.score for s in every), default=0.0), kept


def score(model: Model, x: float) -> float:
    if not model.trained:
        return 0.0
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, model.slope * math.log1p(x) + model.level))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen = (Counter(), Counter())
        for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            seen[toxic].update(set(tokens(text)))
        words = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in seen)],
            names=["token", "clean", "toxic"])


def _weights(sample: DataFrame) -> tuple[dict[str, float], dict[float, float]]:
    """Token weights, and clean tokens by weight (shares)."""
    once = sample.groupBy(F.xxhash64("text")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    counts = (once.select("text", "toxic").mapInArrow(lean(_count), "token string, clean long, toxic long")
              .groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n = counts.agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    clean, toxic = float(n[0]), float(n[1])
    if not clean or not toxic:
        return {}, {0.0: 1.0}
    prior, mass = PRIOR_SHARE * (F.col("clean") + F.col("toxic")), PRIOR_SHARE * (clean + toxic)
    side = lambda c, size: F.log((c + prior) / (size + mass - c - prior))
    odds = side(F.col("toxic"), toxic) - side(F.col("clean"), clean)
    error = CERTAIN * F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    rows = (counts.withColumn("odds", odds).withColumn("error", error)
            .withColumn("weight", F.when(F.col("odds") > F.col("error"), F.col("odds") - F.col("error"))
                        .when(F.col("odds") < -F.col("error"), F.col("odds") + F.col("error")))
            .where(F.col("weight").isNotNull() & ((F.col("toxic") >= MIN_TOXIC) | (F.col("weight") < 0)))
            .select("token", "weight", "clean").collect())
    shares: dict[float, float] = {0.0: 1 - sum(r.clean for r in rows) / clean}
    for r in rows:
        shares[r.weight] = shares.get(r.weight, 0.0) + max(r.clean, 0.5) / clean
    return {r.token: r.weight for r in rows}, shares


def _lambda(shares: dict[float, float]) -> float:
    """Positive root of sum p * exp(lambda * (s - drift)) = 1, by bisection."""
    s, p = np.array(list(shares)) - DRIFT, np.array(list(shares.values()))
    if s.max() <= 0 or (s * p).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    over = lambda x: (p * np.exp(np.minimum(x * s, 700.0))).sum() > 1
    while not over(high):
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if over(mid) else (mid, high)
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level by Newton steps with a slight ridge."""
    a, beta = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag([1e-2, 1e-6]),
                               a.T @ (y - p) - np.array([1e-2, 1e-6]) * beta)
        beta = beta + np.clip(step, -5, 5)
    return float(max(beta[0], 0.0)), float(beta[1])


def _measure(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(len(tokens(t)), *worth(model.value, t)[:2]) for t in b.column("text").to_pylist()]
            n, x, best = (np.array(c) for c in zip(*rows, strict=True)) if rows else (np.zeros(0),) * 3
            yield pa.RecordBatch.from_arrays([b.column("toxic"), *(pa.array(c.astype(float)) for c in (n, x, best))],
                                             names=["toxic", "n", "x", "best"])
    return lean(run)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    """Model from documents (doc_id, text) and labels (doc_id, toxic), of which the
    at most ``most`` documents (see the module) are used."""
    spark = docs.sparkSession
    arrow_batches(spark)
    ids = (labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
           .groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(most)))
           .agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "toxic")).alias("s")).select("s.doc_id", "s.toxic"))
    sample = materialise(docs.select("doc_id", text_or_empty().alias("text"))
                         .join(F.broadcast(ids), "doc_id")          # at most ``most`` rows of 12 bytes
                         .select(F.xxhash64("doc_id").alias("h"), "text", "toxic"), "toxic-sample")
    curve = F.expr("pmod(xxhash64(h), 4) = 0")
    weights, shares = _weights(sample.where(~curve))
    draft = Model(weights, _lambda(shares), 0.0, 1.0, 0.0, True)
    measured = lambda m: sample.where(curve).select("text", "toxic").mapInArrow(
        _measure(share(spark, m)), "toxic int, n double, x double, best double").toPandas()
    got = measured(draft)
    if not len(got):
        return Model({}, 1.0, 0.0, 0.0, 0.0, False)
    plain = got[(got.toxic == 0) & (got.n > 0)]
    log_k = float((plain.best - np.log(plain.n)).mean() - _EULER) if len(plain) else 0.0
    got = measured(draft._replace(log_k=log_k))
    slope, level = _logistic(np.log1p(got.x.to_numpy()), got.toxic.to_numpy(float))
    return draft._replace(log_k=log_k, slope=slope, level=level)


def _score(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            out, passages = [], []
            for text in b.column("text").to_pylist():
                x, _, kept = worth(m, text or "")
                out.append(score(m, x))
                if kept:
                    spans = [t.span(1) for t in _TOKEN.finditer(text.lower())]
                    kept = [{"start": spans[s.first][0], "end": spans[s.last][1], "score": s.score, "worth": w}
                            for s, w in kept]
                passages.append(kept)
            new = {"score": pa.array(out, pa.float64()), "predicted": pa.array([int(s >= THRESHOLD) for s in out], pa.int32()),
                   "passages": pa.array(passages, _PASSAGES)}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else b.column(n) for n in names], names=names)
    return lean(run)


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                ("score", pa.float64()), ("worth", pa.float64())]))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``score``, ``predicted`` and ``passages``: every significant
    toxic passage with its place in code points of the lower-cased text."""
    spark = docs.sparkSession
    arrow_batches(spark)
    out = with_schema(docs, score="double", predicted="int",
                      passages="array<struct<start:int,end:int,score:double,worth:double>>")
    return docs.mapInArrow(_score(share(spark, model), out.names), out)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    model = train(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", "predicted")

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellkpi.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=3):
    """Every anchor against every row."""
    ok = {}
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = min(ok.get(i, (math.inf, [])), (label, [math.floor(256 * x) for x in v]))
    out = set()
    for a, (label, v) in ok.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w, strict=False)) for i, (_, w) in ok.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if ok[i][0] == label][:5]:
            fit = [i for i in order if ok[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out |= {(a, p, k, i, score[p], score[i]) for k, i in enumerate(fit[:3], 1)}
    return out


def mine(spark, rows, every=3, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    df = df.selectExpr("*", "1 AS block", "2 AS page", "'x' AS ids", "3 AS score", "array(4) AS v")          # clashing names
    vectors = hn.labelled_vectors(df, F.col("embedding"), F.col("label"))
    return {tuple(r) for r in hn.hard_negatives(vectors, F.expr(f"vec_id % {every} = 0"), **kw).select(COLUMNS).collect()}


@pytest.mark.parametrize("size", [1 / 64, 40_000.0])
def test_ties_copies_and_small_blocks(spark, size):
    """Few values (so many equal scores), one vector in a third of the rows; floats and long integers."""
    dice = random.Random(3)
    rows = [(i, [size * dice.randrange(-2, 4) for _ in range(6)], dice.randrange(4)) for i in range(260)]
    rows += [(300 + i, [size * 2] * 6, i % 3) for i in range(120)]
    wanted = plain(rows)
    assert len(wanted) > 500 and mine(spark, rows, block=40) == wanted


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [0.9, 2.0], 1), (2, [0.8, 1.9], 2), (3, None, 1), (4, [1.0, None], 1),
            (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [1.0, 2.0], None), (None, [1.0, 2.0], 2), (9, [], 2), (12, [1.5], 2),
            (15, [-3.0, -1.0], 3), (18, [0.0, 0.0], 1), (20, [0.7, 1.7], 2), (21, [0.7, 1.7], 3)]
    assert mine(spark, rows) == plain(rows)


def test_no_rows_and_no_partners(spark):
    assert mine(spark, []) == set()
    assert mine(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == set()         # no positive
    assert mine(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == set()         # no negative


def test_products_too_large_are_an_error(spark):
    with pytest.raises(Exception, match=r"2\*\*62|OVERFLOW"):
        mine(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def test_boxes_bound_every_product():
    dice = np.random.default_rng(1)
    v, anchors = dice.integers(-9, 9, (300, 5)).astype(float), dice.integers(-9, 9, (20, 5)).astype(float)
    order = hn.tile_order(v, [2, 0, 1], hn.LEAF)
    assert sorted(order) == list(range(300))
    tree = hn.Tree(order, order % 3, v[order])
    least, most = hn.intervals(anchors, tree.lo, tree.hi)
    for leaf in range(len(tree.lo)):
        scores = anchors @ v[order[leaf * hn.LEAF:(leaf + 1) * hn.LEAF]].T
        assert (scores.min(axis=1) >= least[:, leaf]).all() and (scores.max(axis=1) <= most[:, leaf]).all()
    spread = (tree.hi - tree.lo).prod(axis=1).mean()
    whole = np.prod(v.max(axis=0) - v.min(axis=0))
    assert spread < whole / 2                            # packing makes boxes small


def test_blocks_out_of_reach_are_ruled_out_before_the_exchange(spark):
    """Two far clusters: an anchor's page goes to blocks of its own cluster only."""
    near = [(i, [10.0 + i % 7 / 7, 0.0], i % 2) for i in range(200)]
    far = [(1000 + i, [-10.0 - i % 7 / 7, 0.0], i % 2) for i in range(200)]
    df = spark.createDataFrame(near + far, "vec_id long, embedding array<double>, label int")
    vectors = hn.labelled_vectors(df, F.col("embedding"), F.col("label"))
    space = hn.Space(2, 3000)
    space.tiles = hn.Tiles.fit(space.matrix([r.v for r in vectors.collect()]).astype(float), 400, 100)
    shared = spark.sparkContext.broadcast(space)
    index = hn.build_index(vectors, shared, 6)
    pages = hn.anchor_pages(vectors.where("vec_id < 1000 AND vec_id % 50 = 0"), shared)
    met = pages.crossJoin(index.groupBy().agg(F.lit(0).alias("part")).withColumn("d", F.lit(1))).drop("d")
    directory = index.select(F.lit(0).alias("part"), "block", "lo", "hi").groupBy("part").applyInPandas(
        hn._pack_directory, "part long, blocks binary, d_lo binary, d_hi binary")
    seeded = met.drop("part").join(index.select("block", "ids", "labels", "vectors"), "block", "left").mapInArrow(hn._seed(shared, 5, True), hn._PAGE)
    routed = seeded.withColumn("part", F.lit(0)).join(directory, "part").mapInArrow(hn._route(shared), hn._PAGE)
    assert {r.block for r in routed.select("block").collect()} < {r.block for r in index.select("block").collect()}


def test_blocks_and_pages_are_never_broadcast(spark, monkeypatch):
    """However small their files are: only the root boxes are, up to a bound on their bytes."""
    plans = {}

    def planned(df, name, write=hn.materialise):
        plans.setdefault(name, []).append(df._jdf.queryExecution().sparkPlan().toString())
        return write(df, name)

    monkeypatch.setattr(hn, "materialise", planned)
    rows = [(i, [math.cos(i), math.sin(i)], i % 3) for i in range(120)]
    assert mine(spark, rows, block=40) == plain(rows)
    assert len(plans["seeded"]) == len(plans["found"]) == len(plans["routes"]) == 2
    assert "Broadcast" not in " ".join(plans["seeded"] + plans["found"]) and all("Broadcast" in p for p in plans["routes"])
    monkeypatch.setattr(hn, "DIRECTORY_BYTES", 0)
    monkeypatch.setattr(hn, "DIRECTORY", 2)
    plans.clear()
    assert mine(spark, rows, block=20) == plain(rows)
    assert "Broadcast" not in " ".join(plans["routes"])

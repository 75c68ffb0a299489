import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.operators import runs
from cellkpi.operators.aggregate import deal_groups
from cellkpi.operators.spec import CounterRule, Item, KpiSpec, Measure, aggregate, sql_feature_aggregate
from cellkpi.plans import family_catalog

SCHEMA = "cell string, hour timestamp, n long, a double, b double, v array<double>, label string, code long"
KEYS = ["cell", "hour"]
WANTED = [runs.Reduction("sum_a", "sum", "a"), runs.Reduction("sum_a0", "sum", "A", True), runs.Reduction("max_b", "max", "b"),
          runs.Reduction("max_b0", "max", "b", True), runs.Reduction("again", "sum", "a"), runs.Reduction("label", "min", "label"),
          runs.Reduction("code", "min", "code"), runs.Reduction("last", "max", "code"),
          *[runs.Reduction(f"v{i}", "sum", "v", False, i) for i in (0, 2)], runs.Reduction("v1_0", "sum", "v", True, 1), runs.Reduction("v1", "max", "v", False, 1)]
SQL = ("sum(a) sum_a, sum(coalesce(a, 0)) sum_a0, max(b) max_b, max(coalesce(b, 0)) max_b0, sum(a) again, min(label) label, min(code) code, "
       "max(code) last, sum(get(v, 0)) v0, sum(get(v, 2)) v2, sum(coalesce(get(v, 1), 0)) v1_0, max(get(v, 1)) v1")


def odd_rows(n=400, nulls=True, seed=1):
    """Groups of one row up to a third of all; NULL keys, values, arrays and labels; NaN; arrays of other lengths."""
    dice = random.Random(seed)
    some = lambda x: None if nulls and dice.random() < 0.3 else x
    number = lambda: dice.choice([dice.randrange(-40, 40) / 4, float("nan")]) if nulls and dice.random() < 0.1 else dice.randrange(-40, 40) / 4
    hour = lambda: some(f"2024-01-0{dice.randrange(1, 4)} 0{dice.randrange(10)}:00:00")
    out = []
    for i in range(n):
        cell, at = ("hot", "2024-01-01 00:00:00") if dice.random() < 0.3 else (some(f"c{dice.randrange(30)}"), hour())
        v = [some(number()) for _ in range(dice.choice([0, 1, 2, 3, 5]) if nulls else 3)]
        out.append((cell, at, i, some(number()), some(number()), some(v), some(dice.choice(["é", "z", "Z", "a", ""])), some(dice.randrange(2**60))))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("timestamp", "string")).withColumn("hour", F.col("hour").cast("timestamp")).repartition(5)


def same(got, wanted):
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*wanted.columns).collect())
    assert text(got) == text(wanted)
    assert [f.dataType for f in got.schema] == [f.dataType for f in wanted.schema] and got.columns == wanted.columns


@pytest.mark.parametrize("batch,steps", [(1, 32), (3, 2), (7, 1), (8192, 32)])
@pytest.mark.parametrize("nulls", [True, False])
def test_runs_equal_groups(spark, monkeypatch, batch, steps, nulls):
    """Runs of any length, over many batches or inside one."""
    monkeypatch.setattr(runs, "BATCH_ROWS", batch)
    monkeypatch.setattr(runs, "STEPS", steps)
    df = frame(spark, odd_rows(nulls=nulls))
    assert runs.reducible(df.schema, KEYS, WANTED)
    wanted = df.groupBy(*KEYS).agg(*[F.expr(f"{x.rsplit(chr(32), 1)[0]} AS {x.rsplit(chr(32), 1)[1]}") for x in _items(SQL)])
    same(runs.aggregate_runs(deal_groups(df, ["cell"], order=KEYS), KEYS, WANTED), wanted)


def _items(sql):
    out, depth, item = [], 0, ""
    for c in sql:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(item.strip())
            item = ""
        else:
            item += c
    return [*out, item.strip()]


def test_no_rows(spark):
    df = frame(spark, odd_rows(3)).where("n < 0")
    assert runs.aggregate_runs(deal_groups(df, ["cell"], order=KEYS), KEYS, WANTED).count() == 0


def test_what_is_left_to_spark():
    schema = T._parse_datatype_string(SCHEMA + ", f float, d decimal(9, 2)")
    can = lambda *r, keys=KEYS: runs.reducible(schema, keys, [runs.Reduction("x", *r)])
    assert can("sum", "a") and can("min", "label") and can("sum", "v", True, 4)
    assert not can("avg", "a") and not can("min", "a") and not can("sum", "code") and not can("sum", "d") and not can("max", "label")
    assert not can("sum", "v") and not can("sum", "a", False, 1) and not can("sum", "missing")
    assert not can("sum", "a", keys=["cell", "a"]) and not can("sum", "a", keys=[])


def test_a_long_run_is_held_as_one_row():
    schema = pa.schema([pa.field("k", pa.string()), pa.field("s", pa.float64(), False)])
    run = runs._reduce_runs(1, ["a"], [("a", "sum", True, None, [(None, 1)])], schema)
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 1000), pa.array(np.ones(1000))], names=["k", "a"])
    out = list(run(iter([batch] * 50)))
    assert [b.to_pylist() for b in out] == [[{"k": "x", "s": 50_000.0}]]


SPEC = KpiSpec(name="w", hour_key="hour", time_keys=("hour",), keys=("cell",), identity=("n", "code"),
               items=(Measure("min", "label", "label"), Item("hour", "time", "hour"), Item("cell", "key", "cell"),
                      CounterRule(func="sum", null_policy="zero", omit=("label",))))


def widen(rows):
    return rows.select("*", *[(F.col("a") * i).alias(f"w_{i}") for i in range(20)])


def hash_aggregates(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [x for x in plan.split("\n") if "Aggregate [" in x and "sum(" in x]


def test_a_wide_spec_is_added_up_by_runs(spark):
    df = frame(spark, odd_rows()).drop("v")
    plain = aggregate(widen(df), SPEC, grain="rop", extra_keys=())
    wide = aggregate(df, SPEC, grain="rop", extra_keys=(), widen=widen, by=["cell"])
    same(wide, plain)
    assert hash_aggregates(plain) and not hash_aggregates(wide)
    unfit = KpiSpec(**{**SPEC.__dict__, "items": (*SPEC.items, Measure("avg", "a", "mean"))})
    same(aggregate(df, unfit, grain="rop", extra_keys=(), widen=widen, by=["cell"]), aggregate(widen(df), unfit, grain="rop", extra_keys=()))


def test_a_text_spec_is_added_up_by_runs(spark):
    df = frame(spark, odd_rows()).drop("v")
    select = "'x' as RUN, MIN(label) as Label, hour as AT, cell, SUM(a) as a, SUM(IFNULL(w_3, 0)) as w3, MAX(w_4) as w_4, SUM(w_5), 0 as none"
    plain = sql_feature_aggregate(widen(df), select, "hour, cell", extra_keys=())
    dealt = sql_feature_aggregate(widen(deal_groups(df, ["cell"], order=["hour", "cell"])), select, "hour, cell", extra_keys=(), dealt=True)
    same(dealt, plain)
    assert hash_aggregates(plain) and not hash_aggregates(dealt)
    for other in ("count(a) as n", "sum(a * 2) as twice", "first(a) as a"):
        got = sql_feature_aggregate(widen(deal_groups(df, ["cell"], order=["hour", "cell"])), f"cell, SUM(w_2) as w_2, {other}", "cell", extra_keys=(), dealt=True)
        assert hash_aggregates(got) and got.count() == df.select("cell").distinct().count()


@pytest.mark.parametrize("name", ["family_eric_lte_wide", "family_eric_lte_older", "family_eric_umts_older"])
def test_wide_families_are_added_up_by_runs(spark, name):
    df = getattr(family_catalog, name)(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and not hash_aggregates(df)


def test_partition_keys_are_derived_after_the_exchange(spark):
    df = family_catalog.family_eric_umts_older(spark, "/root/testdata/sf0.001")
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "RepartitionByExpression" in x)
    assert "AS pk_date" not in "".join(lines[at:]) and "AS pk_date" in "".join(lines[:at])

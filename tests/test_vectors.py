"""Histograms as arrays and labels as codes, from schema to report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.operators.spec import CounterRule, Item, KpiSpec, Measure, aggregate
from cellkpi.plans import vector_catalog
from cellkpi.plans.jobs import report
from cellkpi.sources import store
from cellkpi.sources.labels import read_labels
from cellkpi.sources.store import read_index, read_store, write_store
from cellkpi.sources.vectors import bin_names, pack_vectors, unpack_vectors, vector_families


def _schema(text):
    return T._parse_datatype_string(text)


def test_families_are_runs_of_one_numeric_type(spark):
    s = _schema("a_0 double, a_1 double, a_2 double, b_1 double, b_2 double, b_5 double, c_01 long, c_02 long, c_03 long, "
                "d_0 double, d_1 long, e_0 string, e_1 string, f_7 double, plain double")
    assert vector_families(s) == {"a": ["a_0", "a_1", "a_2"], "c": ["c_01", "c_02", "c_03"]}
    wide = T.StructType([T.StructField(f"v{i}_{j}", T.DoubleType()) for i in range(200) for j in range(12 if i < 158 else 11)])
    found = vector_families(wide)
    assert len(found) == 200 and sum(map(len, found.values())) == 2358


def test_pack_and_unpack_keep_names_order_and_nulls(spark, tmp):
    df = spark.createDataFrame([("x", 1.0, None, 3.0, 9), (None, None, None, None, None)], "k string, a_0 double, a_1 double, a_2 double, A long")
    packed = pack_vectors(df)
    assert packed.columns == ["k", "a_bins", "A"]                   # the plain name is taken
    packed.write.parquet(f"{tmp}/p")
    back = spark.read.parquet(f"{tmp}/p")
    assert bin_names(back.schema["a_bins"]) == ["a_0", "a_1", "a_2"]
    flat = unpack_vectors(back)
    assert flat.columns == df.columns and sorted(map(repr, flat.collect())) == sorted(map(repr, df.collect()))


SPEC = KpiSpec(name="t", items=(Item("cell", "key", "cell"), Measure("min", "oss", "oss"),
                                CounterRule(func="sum", null_policy="keep", overrides=(("h_1", "max"),), renames=(("h_0", "first_0"),),
                                            also=(("g_1", "twin"),), omit=("h_2",))),
               keys=("cell",), time_keys=("ts",), hour_key="ts", identity=("cell", "oss", "ts"))


def _rows(spark):
    t = dt.datetime(2024, 1, 5, 10)
    return spark.createDataFrame([("c", "b", t, 1.0, 2.0, 3.0, 4.0, None), ("c", "a", t, 5.0, 1.0, 1.0, None, None), ("d", None, t, None, None, 0.0, 2.0, 7.0)],
                                 "cell string, oss string, ts timestamp, h_0 double, h_1 double, h_2 double, g_0 double, g_1 double")


def test_spec_over_packed_rows_equals_flat_rows(spark):
    flat = aggregate(_rows(spark), SPEC, extra_keys=())
    packed = aggregate(pack_vectors(_rows(spark)), SPEC, extra_keys=())
    assert packed.columns == flat.columns == ["cell", "oss", "first_0", "h_1", "g_0", "g_1", "twin"]
    assert sorted(map(repr, flat.collect())) == sorted(map(repr, packed.collect()))
    arrays = aggregate(pack_vectors(_rows(spark)), SPEC, extra_keys=(), packed=True)
    assert "g" in arrays.columns and {r.cell: r.g for r in arrays.collect()} == {"c": [4.0, None], "d": [2.0, 7.0]}


def test_store_keeps_arrays_and_its_label_dictionary(spark, tmp):
    rows = pack_vectors(_rows(spark)).selectExpr("*", "'f' AS pk_ft", "'2024-01-05' AS pk_date", "'M' AS pk_market", "'10' AS pk_hr")
    write_store(rows, f"{tmp}/s", labels=("oss",))
    write_store(rows.withColumn("oss", F.lit("Z")).where("cell = 'd'"), f"{tmp}/s", labels=("oss",))
    assert {r.text for r in read_labels(spark, f"{tmp}/s").collect()} == {"a", "b", "Z"}
    store, index = read_store(spark, f"{tmp}/s"), read_index(spark, f"{tmp}/s")
    got = report(store, SPEC, grain="rop", index=index, labels=read_labels(spark, f"{tmp}/s"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Scan parquet") <= 6
    assert {r.cell: (r.oss, r.g_1) for r in got.collect()} == {"c": ("a", None), "d": ("Z", 14.0)}


def test_histograms_are_added_after_the_exchange(spark, tmp, monkeypatch):
    """Rows of a store are dealt by ranges before they are wide, a large family-day too."""
    rows = [(i, "f" if i < 90 else None, "2024-01-05", "m1" if i % 3 else None, "07" if i < 80 else "08") for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, pk_ft string, pk_date string, pk_market string, pk_hr string").repartition(3)
    seen = []

    def widen(r):
        seen.append(r._jdf.queryExecution().optimizedPlan().toString())
        return r.select("*", F.array(F.col("event_id") * 1.0, F.lit(None)).alias("v"))

    monkeypatch.setattr(store, "WIDE_ROWS_A_TASK", 25)
    store.write_store(df, f"{tmp}/narrow", widen=widen, cache=False)
    store.write_store(widen(df), f"{tmp}/wide", cache=False)
    got, wanted = (spark.read.parquet(f"{tmp}/{x}").select("event_id", "pk_ft", "pk_date", "pk_market", "pk_hr", "v") for x in ("narrow", "wide"))
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect())) and got.count() == 120
    assert "RepartitionByExpression" in seen[0] and len(got.where("pk_ft = 'f'").select(F.input_file_name()).distinct().collect()) >= 3
    assert sorted(map(str, store.read_index(spark, f"{tmp}/narrow").collect())) == sorted(map(str, store.read_index(spark, f"{tmp}/wide").collect()))


def test_vector_store_report_shuffles_no_histogram(spark, monkeypatch):
    asked = {}

    def write(df, path, **kw):
        asked.update(kw, df=df)
        raise InterruptedError

    monkeypatch.setattr(vector_catalog, "write_store", write)
    with pytest.raises(InterruptedError):
        vector_catalog.vector_store_report(spark, "/root/testdata/sf0.001")
    arrays = lambda df: [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    assert not arrays(asked["df"]) and len(arrays(asked["widen"](asked["df"]))) == vector_catalog.VECTORS

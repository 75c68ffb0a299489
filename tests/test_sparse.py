"""All families in one table: views equal the families' rows, one scan gives all reports."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellkpi.operators.spec import CounterRule, Item, KpiSpec, Measure
from cellkpi.plans.jobs import report
from cellkpi.plans.sparse import report_sparse, to_sparse, typed_view, write_sparse
from cellkpi.sources.store import PK, read_index, read_store


def rows(spark, n, *counters, key="MO_DN"):
    return spark.range(n).selectExpr(
        f"concat('d', id % 4) AS {key}", "IF(id % 9 = 0, NULL, concat('O', id % 2)) AS OSS",
        "timestampadd(MINUTE, 15 * (id % 300), TIMESTAMP'2024-01-05 00:00:00') AS PERIOD_START_TIME", *counters).withColumns({
            "pk_date": F.date_format("PERIOD_START_TIME", "yyyy-MM-dd"), "pk_hr": F.date_format("PERIOD_START_TIME", "HH"),
            "pk_market": F.concat(F.lit("M"), F.pmod(F.hash(key), F.lit(3)))})


def frames(spark):
    return {"a": rows(spark, 700, "cast(id AS double) AS x", "IF(id % 3 = 0, NULL, id) AS `it's`", "cast(id % 7 AS string) AS t"),
            "b": rows(spark, 500, "cast(id % 5 AS int) AS x", "cast(NULL AS double) AS none", key="SRC"),
            "c": rows(spark, 90, *[f"cast(id * {i} AS double) AS c{i}" for i in range(12)])}


def spec(name, key, **kw):
    return KpiSpec(name, (Item("RUN", "run_id", "unassigned"), Measure("min", "OSS", "oss"), Measure("count", "*", "n"),
                          Item("PERIOD", "time", "PERIOD_START_TIME"), Item("cell", "key", key), CounterRule(**kw)),
                   keys=(key.lower(),), time_keys=("PERIOD_START_TIME",), hour_key="PERIOD_START_TIME", identity=("OSS",))


SPECS = {"a": spec("a", "MO_DN", overrides=(("t", "max"), ("x", "avg"))), "b": spec("b", "SRC", null_policy="zero", overrides=(("x", "max"),)),
         "c": spec("c", "MO_DN", renames=(("c3", "three"),))}


def bag(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())


@pytest.fixture()
def store(spark, tmp):
    made = frames(spark)
    write_sparse(made, f"{tmp}/s")
    return made, f"{tmp}/s"


def test_views_give_back_rows_and_types(spark, store):
    made, path = store
    for family, df in made.items():
        view = typed_view(read_store(spark, path), family, df.schema)
        assert {f.name: f.dataType for f in view.schema if f.name not in PK} == {f.name: f.dataType for f in df.schema if f.name not in PK}
        assert bag(view.drop("pk_ft")) == bag(df)


@pytest.mark.parametrize("grain", ["hour", "rop"])
def test_reports_of_all_families_equal_the_single_ones(spark, store, grain):
    made, path = store
    got = report_sparse(spark, path, SPECS, {f: df.schema for f, df in made.items()}, latest_n=2, grain=grain)
    assert set(got) == set(SPECS)
    for family, df in made.items():
        view = typed_view(read_store(spark, path), family, df.schema)
        want = report(view, SPECS[family], latest_n=2, grain=grain, index=read_index(spark, path).where(F.col("pk_ft") == family))
        assert dict(got[family].dtypes) == dict(want.dtypes)
        assert bag(got[family]) == bag(want) and got[family].count()


def test_refused_input_empty_families_and_new_counters(spark, store):
    made, path = store
    with pytest.raises(TypeError):
        to_sparse(made["a"].withColumn("pk_ft", F.lit("a")).withColumn("v", F.array(F.lit(1))))
    with pytest.raises(ValueError):
        report_sparse(spark, path, SPECS, {}, grain="day")
    more = made["c"].withColumn("fresh", F.lit(2.5))
    write_sparse({"c": more, "d": made["c"].where("false")}, path)          # no schema changes
    schemas = {"c": more.schema, "d": made["c"].schema}
    got = report_sparse(spark, path, {"c": SPECS["c"], "d": SPECS["c"]}, schemas, latest_n=24)
    assert got["d"].count() == 0
    view = typed_view(read_store(spark, path), "c", more.schema)
    assert view.count() == 180 and view.where("fresh IS NULL").count() == 90

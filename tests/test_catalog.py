"""Every catalogue query against its DuckDB twin on the smallest driver tables,
plus properties of the grains."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries as every_query
from cellkpi.plans import catalog
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def queries():
    """The library's own queries (those of other subpackages have tests there)."""
    return dict(catalog.Q)


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else
                         (round(float(v), 4) if isinstance(v, float) else str(v)) for v in r))
    return sorted(out, key=repr)


def test_every_query_has_oracle():
    assert set(queries()) == set(catalog.SQL)
    assert set(queries()) <= set(every_query()) and set(catalog.SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    got = _norm(sdf.select(*cols).collect())
    o = con.execute(oracle_sql()[name]).df()
    assert sorted(o.columns) == cols
    exp = _norm(o[cols].itertuples(index=False))
    assert got == exp


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "MGR_RUN_ID" in df.columns


def test_hourly_sums_roll_up_to_daily(spark):
    from pyspark.sql import functions as F
    q = queries()
    h = q["kpi_hourly"](spark, SF001).groupBy("pk_ft", "pk_date", "pk_market", "cell") \
        .agg(F.round(F.sum("cnt"), 0).alias("n"))
    d = q["daily_rollup"](spark, SF001).select("pk_ft", "pk_date", "pk_market", "cell", F.col("cnt").alias("n"))
    assert h.exceptAll(d).count() == 0 and d.exceptAll(h).count() == 0


def test_report_at_most_n_hours_per_market(spark):
    from pyspark.sql import functions as F
    r = queries()["kpi_report"](spark, SF001)
    per = r.select("pk_ft", "pk_market", "pk_date", "pk_hr").distinct().groupBy("pk_ft", "pk_market").count()
    assert per.agg(F.max("count")).first()[0] <= 3

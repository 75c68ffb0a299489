"""Queries of the subpackage that SQL can express, against it, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from cellkpi.llm import catalog

SF001 = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(catalog.Q) | {"pipeline"} <= set(queries()) and set(catalog.SQL) <= set(oracle_sql())
    assert {name.split("_")[0] for name in catalog.Q} == {f"op{n}" for n in range(1, len(catalog.Q) + 1)}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    wanted = con.execute(catalog.SQL[name]).df()
    got = catalog.Q[name](spark, SF001)
    cols = sorted(wanted.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(wanted[cols].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(set(catalog.Q) - set(catalog.SQL)))
def test_query_runs_over_its_whole_table(spark, name):
    rows = catalog.Q[name](spark, SF001).collect()
    if name != "op10_decontaminate":
        assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()

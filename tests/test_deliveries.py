"""Columns bound by each file's own header; hours that late rows open again."""

import os

import pytest
from pyspark.sql import types as T

from cellkpi.sources import headers
from cellkpi.streaming.hourly import hourly_window_reopened, read_late_rows, read_reopened_windows
from tests.conftest import write_text

SCHEMA = T.StructType([T.StructField("cell", T.StringType()), T.StructField("pmA", T.LongType()), T.StructField("pmB", T.DoubleType())])


def test_columns_are_bound_by_name(spark, tmp):
    write_text(f"{tmp}/in/a.csv", "cell,pmA,pmB\nc1,1,1.5\n c2 ,x,\n")
    write_text(f"{tmp}/in/b {{1}}.csv", '﻿"pmB" , CELL,pmNew,pma\r\n2.5,c3,9,3\r\n')
    write_text(f"{tmp}/in/c.csv", "pmB,cell\n")                   # only a header
    write_text(f"{tmp}/in/d.csv", "cell,pmA,pmA\nc4,4,5\n")       # a repeated name: its first column
    write_text(f"{tmp}/in/e.csv", "")                             # not a byte
    got = headers.read_by_header(spark, f"{tmp}/in", SCHEMA)
    assert got.dtypes == [("cell", "string"), ("pmA", "bigint"), ("pmB", "double")]
    assert sorted(map(tuple, got.collect())) == [("c1", 1, 1.5), ("c2", None, None), ("c3", 3, 2.5), ("c4", 4, None)]
    listed = headers.read_by_header(spark, [f"{tmp}/in/a.csv", f"{tmp}/in/c.csv"], SCHEMA, with_source=True)
    assert {os.path.basename(r._source_file) for r in listed.collect()} == {"a.csv"}
    drift = {r.path.rsplit("/", 1)[1][0]: r for r in headers.header_drift(spark, f"{tmp}/in", SCHEMA).collect()}
    assert set(drift) == {"b", "c", "d"}
    assert (drift["b"].missing, drift["b"].unknown, drift["b"].reordered) == ([], ["pmnew"], True)
    assert (drift["c"].missing, drift["c"].reordered) == (["pma"], True)
    assert (drift["d"].missing, drift["d"].repeated, drift["d"].reordered) == (["pmb"], 1, False)


def test_without_a_schema_names_come_from_all_headers(spark, tmp):
    write_text(f"{tmp}/a.txt", "cell|v\nc1|1\n")
    write_text(f"{tmp}/b.txt", "w|CELL\n7|c2\n")
    got = headers.read_by_header(spark, [f"{tmp}/a.txt", f"{tmp}/b.txt"], sep="|")
    assert got.columns == ["cell", "v", "w"]
    assert sorted(map(tuple, got.collect())) == [("c1", "1", None), ("c2", None, "7")]


def test_no_header_at_all_and_too_many(spark, tmp, monkeypatch):
    write_text(f"{tmp}/none/a.csv", "")
    assert headers.read_by_header(spark, f"{tmp}/none", SCHEMA).collect() == []
    for i in range(3):
        write_text(f"{tmp}/many/{i}.csv", f"cell,x{i}\nc,1\n")
    monkeypatch.setattr(headers, "MAX_HEADERS", 2)
    with pytest.raises(ValueError, match="different headers"):
        headers.read_by_header(spark, f"{tmp}/many", SCHEMA)


def test_a_row_beyond_the_lateness_reopens_its_hour(spark, tmp):
    def run(rows):
        spark.createDataFrame(rows, "cell string, t string, value double").selectExpr(
            "cell", "to_timestamp(t) AS PERIOD_START_TIME", "value").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema("cell string, PERIOD_START_TIME timestamp, value double").parquet(f"{tmp}/in")
        q = hourly_window_reopened(stream, f"{tmp}/log", f"{tmp}/ck", lateness="2 hours")
        q.awaitTermination()
        assert q.exception() is None

    run([("a", "2024-01-05 10:00:00", 1.0), ("a", "2024-01-05 15:00:00", 2.0), ("a", "2024-01-05 10:15:00", 4.0)])
    run([("a", "2024-01-05 12:00:00", 8.0),          # its hour ends at 13:00, the limit: late
         ("a", "2024-01-05 12:59:00", None), ("a", "2024-01-05 13:00:00", 16.0), ("b", None, 32.0)])
    run([("a", "2024-01-05 10:30:00", 64.0)])
    got = {str(r.window_start)[11:13]: (r.value, r.n_rows, r.n_late) for r in read_reopened_windows(spark, f"{tmp}/log").collect()}
    assert got == {"10": (69.0, 3, 1), "12": (8.0, 2, 2), "13": (16.0, 1, 0), "15": (2.0, 1, 0)}
    late = sorted((r._reason, r.value) for r in read_late_rows(spark, f"{tmp}/log").collect() if r.value is not None)
    assert late == [("late", 8.0), ("late", 64.0), ("no period", 32.0)]

"""Counters dealt by the lookup's key: the rows of the plain join, without moving counters."""

import glob
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellkpi.operators.enrich import enrich
from cellkpi.sources.copartitioned import KEY, enrich_copartitioned, open_copartitioned, write_copartitioned

BUCKETS = 6
ATTRS = {"HL_Market": "MARKET", "HL_Site": "SITE"}


def counters(spark, first, n):
    """A third of all rows belong to cell 7; some have no OSS or no cell; OSS in mixed case."""
    return spark.range(first, first + n).selectExpr(
        "id AS event_id", "IF(id % 11 = 0, NULL, IF(id % 2 = 0, 'oss_a', 'OSS_A')) AS oss",
        "IF(id % 13 = 0, NULL, IF(id % 3 = 0, 7, id % 50)) AS cell", "cast(id AS double) AS v",
        "concat('f', id % 2) AS pk_ft", "IF(id % 4 = 0, '2024-01-05', '2024-01-06') AS pk_date")


def lookup(spark):
    rows = spark.range(40).selectExpr("'Oss_a' AS OSS", "cast(id AS string) AS CELL", "concat('M', id % 4) AS MARKET",
                                      "IF(id % 5 = 0, NULL, concat('S', id)) AS SITE")
    return rows.unionByName(rows.withColumn("MARKET", F.lit("Z")).where("CELL < 9"))          # repeated keys


def deal(rows, path, batch, **kw):
    write_copartitioned(rows, path, batch, oss_col="oss", cell_col="cell", buckets=BUCKETS, **{"hot_rows": 100, **kw})


def ours(spark, path, **kw):
    return enrich_copartitioned(spark, path, lookup(spark), lookup_cell_col="CELL", attrs=ATTRS, **kw)


def plain(spark, rows):
    return enrich(rows, lookup(spark), oss_col="oss", cell_col="cell", lookup_cell_col="CELL", attrs=ATTRS)


def bag(df):
    return Counter(tuple(r) for r in df.select("event_id", "oss", "cell", "v", "pk_ft", "pk_date", *ATTRS).collect())


def test_rows_of_the_plain_join_and_counters_stay_where_they_lie(spark, tmp):
    path, rows = f"{tmp}/s", counters(spark, 0, 900)
    again = counters(spark, 900, 300).unionByName(counters(spark, 900, 50))                  # repeated rows stay repeated
    deal(rows, path, "b0")
    deal(again, path, "b1", hot_rows=20)                                                      # more salts than before
    got = ours(spark, path)
    assert bag(got) == bag(plain(spark, rows.unionByName(again)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, line in enumerate(plan.splitlines()) if "copartitioned_" in line)
    depth = [re.search(r"[A-Za-z]", line).start() for line in plan.splitlines()]
    above, at = [], depth[scan]
    for i in range(scan - 1, -1, -1):                                                         # the scan's ancestors
        if depth[i] < at:
            above.append(plan.splitlines()[i])
            at = depth[i]
    assert any("SortMergeJoin" in a for a in above) and not any("Exchange" in a for a in above), plan
    assert "Bucketed: true" in plan


def test_a_hot_key_and_rows_without_a_key_lie_in_many_buckets(spark, tmp):
    path = f"{tmp}/s"
    deal(counters(spark, 0, 1200), path, "b0", hot_rows=30)
    seen = open_copartitioned(spark, path)
    assert seen.where("cell = 7 AND oss IS NOT NULL").select(KEY).distinct().count() > BUCKETS
    assert seen.where("oss IS NULL OR cell IS NULL").select(KEY).distinct().count() > BUCKETS
    files = glob.glob(f"{path}/pk_ft=*/pk_date=*/*.parquet")
    assert {re.search(r"_(\d{5})\.c000", f).group(1) for f in files} == {f"{b:05d}" for b in range(BUCKETS)}
    of_bucket = seen.groupBy(F.pmod(F.hash(KEY), F.lit(BUCKETS))).count().collect()
    assert max(r["count"] for r in of_bucket) < 1200 / 3


def test_folders_are_pruned_empty_batches_and_other_keys(spark, tmp):
    path, rows = f"{tmp}/s", counters(spark, 0, 300)
    deal(rows.where("false"), path, "b0")
    assert not ours(spark, path).count()
    deal(rows, path, "b1")
    day = ours(spark, path, where=F.col("pk_date") == "2024-01-05")
    assert bag(day) == bag(plain(spark, rows.where("pk_date = '2024-01-05'")))
    with pytest.raises(ValueError):
        write_copartitioned(rows, path, "b2", oss_col="pk_ft", cell_col="cell")
    with pytest.raises(ValueError):
        deal(rows.withColumn(KEY, F.lit("x")), path, "b3")

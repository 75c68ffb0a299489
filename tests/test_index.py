"""Partition index table: maintained by store writes, exact after appends and
dynamic overwrites, rebuilt and compacted without changing its content."""

import glob
import os

from pyspark.sql import functions as F

from cellkpi.operators import select as sel
from cellkpi.plans.jobs import report
from cellkpi.operators.spec import Item, KpiSpec, Measure
from cellkpi.sources.store import (PK, compact_index, index_path, read_index, read_store, rebuild_index,
                                   write_store)

SCHEMA = "pk_ft string, pk_date string, pk_market string, pk_hr string, cell string, v double"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _expected(store):
    return sorted(map(tuple, store.groupBy(*PK).agg(F.count(F.lit(1)).alias("n_rows")).collect()))


def _index(spark, p):
    return sorted(map(tuple, read_index(spark, p).select(*PK, "n_rows").collect()))


def test_index_follows_appends_and_overwrites(spark, tmp):
    p = os.path.join(tmp, "store")
    a = _rows(spark, [("f1", "2024-01-05", "NY", "07", "c1", 1.0), ("f1", "2024-01-05", "NY", "07", "c2", 2.0),
                      ("f1", "2024-01-06", "LI", "00", "c3", 3.0)])
    write_store(a, p, mode="append")
    late = _rows(spark, [("f1", "2024-01-05", "NY", "07", "c1", 4.0), ("f2", "2024-01-06", "NY", "23", "c1", 5.0)])
    write_store(late, p, mode="append")
    assert _index(spark, p) == _expected(read_store(spark, p))
    assert ("f1", "2024-01-05", "NY", "07", 3) in _index(spark, p)          # late rows add to the count
    # dynamic overwrite of one family-day replaces its index rows too
    redo = _rows(spark, [("f1", "2024-01-05", "NY", "09", "c9", 9.0)])
    write_store(redo, p, mode="overwrite")
    got = _index(spark, p)
    assert got == _expected(read_store(spark, p))
    assert not any(r[:4] == ("f1", "2024-01-05", "NY", "07") for r in got)
    assert os.path.isdir(index_path(p)) and read_store(spark, p).count() == 3     # index hidden from the store


def test_rebuild_and_compact_keep_content(spark, tmp):
    p = os.path.join(tmp, "store")
    for h in ("05", "06", "07"):
        write_store(_rows(spark, [("f1", "2024-01-05", "NY", h, "c1", 1.0), ("f1", "2024-01-06", "NY", h, "c1", 1.0)]),
                    p, mode="append")
    before = _index(spark, p)
    files = lambda: len(glob.glob(os.path.join(index_path(p), "pk_ft=f1", "pk_date=2024-01-05", "*.parquet")))
    assert files() == 3
    compact_index(spark, p, since="2024-01-05")
    assert _index(spark, p) == before and files() == 1
    compact_index(spark, p)                                        # no date bound: every family-day
    day2 = glob.glob(os.path.join(index_path(p), "pk_ft=f1", "pk_date=2024-01-06", "*.parquet"))
    assert _index(spark, p) == before and files() == 1 and len(day2) == 1
    rebuild_index(spark, p)
    assert _index(spark, p) == before == _expected(read_store(spark, p))


def store_partitions_read(df, marker_col="cell"):
    """Run ``df`` and return, per store scan of its final (AQE) plan, the
    number of partitions actually read (run-time metric, after pruning)."""
    df.collect()
    out = []

    def walk(n):
        if "QueryStage" in n.nodeName():
            walk(n.plan())
        if n.nodeName().startswith("Scan") and marker_col in n.output().toString() \
                and n.metrics().contains("numPartitions"):
            out.append(n.metrics().apply("numPartitions").value())
        it = n.children().iterator()
        while it.hasNext():
            walk(it.next())

    root = df._jdf.queryExecution().executedPlan()
    walk(root.executedPlan() if root.nodeName().startswith("AdaptiveSparkPlan") else root)
    return out


def test_report_selects_from_index_and_prunes_at_run_time(spark, tmp):
    p = os.path.join(tmp, "store")
    rows = [("f1", d, "NY", h, "c1", 1.0) for d in ("2024-01-03", "2024-01-04", "2024-01-05") for h in ("01", "02")]
    write_store(_rows(spark, rows), p, mode="append")
    spec = KpiSpec(name="t", items=(Item("cell", "key", "cell"), Measure("sum", "v", "v")), keys=("cell",),
                   time_keys=(), hour_key="pk_hr")
    r = report(read_store(spark, p), spec, latest_n=3, grain="day", index=read_index(spark, p))
    got = sorted((x.pk_date, x.v) for x in r.collect())
    assert got == [("2024-01-04", 1.0), ("2024-01-05", 2.0)]            # newest 3 hours across two dates
    assert store_partitions_read(r) == [2]                               # 2 of 3 family-days read
    one = report(read_store(spark, p), spec, latest_n=1, grain="day", index=read_index(spark, p))
    assert store_partitions_read(one) == [1]
    assert sel.latest_hours(read_index(spark, p), 3).count() == 3


def test_report_property_matches_brute_force(spark, tmp):
    """Random stores (families x markets x dates x hours): the report over
    index + written selection + pruned scan equals a plain Python answer."""
    import itertools
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    dates = [f"2024-01-0{d}" for d in range(1, 6)]
    hours = [f"{h:02d}" for h in (0, 5, 23)]
    cells = list(itertools.product(("f1", "f2"), ("NY", "LI", "SF"), dates, hours))
    counter = itertools.count()

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.sampled_from(cells), st.integers(1, 3)), min_size=1, max_size=25),
           st.integers(1, 4))
    def check(picks, n):
        rows = [(ft, d, m, h, f"c{k}", float(k)) for (ft, m, d, h), k in picks]
        p = os.path.join(tmp, f"store-{next(counter)}")
        write_store(_rows(spark, rows), p, mode="append")
        spec = KpiSpec(name="t", items=(Item("cell", "key", "cell"), Measure("sum", "v", "v")), keys=("cell",),
                       time_keys=(), hour_key="pk_hr")
        got = sorted((r.pk_ft, r.pk_market, r.pk_date, r.pk_hr, r.cell, r.v) for r in
                     report(read_store(spark, p), spec, latest_n=n, grain="hour",
                            index=read_index(spark, p)).collect())
        parts = {(ft, m): set() for ft, d, m, h, _, _ in rows}
        for ft, d, m, h, _, _ in rows:
            parts[(ft, m)].add((d, h))
        keep = {(ft, m, d, h) for (ft, m), s in parts.items() for d, h in sorted(s, reverse=True)[:n]}
        exp = {}
        for ft, d, m, h, c, v in rows:
            if (ft, m, d, h) in keep:
                exp[(ft, m, d, h, c)] = exp.get((ft, m, d, h, c), 0.0) + v
        assert got == sorted((*k, v) for k, v in exp.items())

    check()


def test_report_skips_row_groups_of_other_hours(spark, tmp):
    """Inside a pruned family-day the store is clustered by hour and the
    selected hours are pushed into the scan: row groups of other hours are
    not read."""
    p = os.path.join(tmp, "store")
    rows = [("f1", "2024-01-05", "NY", f"{h:02d}", f"c{i}", 1.0) for h in range(24) for i in range(300)]
    write_store(_rows(spark, rows).repartition(4), p, mode="overwrite", row_group_bytes=4096)
    spec = KpiSpec(name="t", items=(Item("cell", "key", "cell"), Measure("sum", "v", "v")), keys=("cell",),
                   time_keys=(), hour_key="pk_hr")
    r = report(read_store(spark, p), spec, latest_n=1, grain="hour", index=read_index(spark, p))
    assert r.count() == 300 and {x.pk_hr for x in r.select("pk_hr").distinct().collect()} == {"23"}
    r.collect()
    read = []

    def walk(n):
        if "QueryStage" in n.nodeName():
            walk(n.plan())
        if n.nodeName().startswith("Scan") and "cell" in n.output().toString():
            read.append(n.metrics().apply("numOutputRows").value())
        it = n.children().iterator()
        while it.hasNext():
            walk(it.next())

    root = r._jdf.queryExecution().executedPlan()
    walk(root.executedPlan() if root.nodeName().startswith("AdaptiveSparkPlan") else root)
    assert read and read[0] < 24 * 300 / 4                       # far fewer than the day's 7200 rows

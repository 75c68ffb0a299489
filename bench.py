"""Headline-query benchmark.

Runs the catalogue's headline queries at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is timed end to end (plan + full materialisation via a noop
write); the store ingest is timed separately as "ingest_store". Before the
timed runs the JVM is warmed once with the flagship on the smallest tables
(sf0.001, not timed), so the first timed query does not carry JIT start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellkpi.plans import catalog  # noqa: E402
from cellkpi.session import get_session  # noqa: E402

HEADLINE = [
    "kpi_report", "kpi_report_daily", "kpi_rop", "kpi_hourly", "daily_rollup",
    "hour_day_grouping_sets", "enrich_eric_lte", "enrich_nokia_lte", "latest_n_hours",
    "partition_index", "agg_from_schema", "vector_counter_sum", "kpi_bulk_hourly",
    "kpi_bulk_report", "read_counters_csv", "export_csv", "family_eric_lte_rop",
    "family_nokia_lte_cell_load", "dedup_redelivered", "family_eric_lte_wide",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app="cellkpi-bench", shuffle_partitions=int(cpus) * 2,
                        conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and warm != sf_dir:
        run(catalog.Q["kpi_report"](spark, warm))

    t = time.perf_counter()
    catalog.store(spark, sf_dir)
    timings["ingest_store"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    catalog.bulk_store_path(spark, sf_dir)
    timings["ingest_bulk_store"] = round(time.perf_counter() - t, 3)

    for name in HEADLINE:
        fn = catalog.Q[name]
        t = time.perf_counter()
        run(fn(spark, sf_dir))
        timings[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Catalogue entry for roll-ups kept as mergeable states."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellkpi.plans import rollups
from cellkpi.plans.catalog import BASE, ekc, finish, q
from cellkpi.session import scratch_path
from cellkpi.sources import ledger

_KEYS, _COUNTERS = ["cell"], ["value", "v_null"]
_FINALS = ", ".join(f"round(sum({c}), 4) AS {c}_sum, round(avg({c}), 4) AS {c}_avg, round(max({c}), 4) AS {c}_max, round(min({c}), 4) AS {c}_min"
                    for c in _COUNTERS)


@q("rollup_refresh", BASE.rstrip("\n") + f"""
SELECT CASE WHEN grouping(pk_hr) = 1 THEN 'day' ELSE 'hour' END AS grain, pk_ft, pk_date, pk_market, pk_hr, cell, count(*) AS n_rows, {_FINALS}
FROM ekc GROUP BY GROUPING SETS ((pk_ft, pk_date, pk_market, pk_hr, cell), (pk_ft, pk_date, pk_market, cell))""")
def rollup_refresh(spark, sf):
    """The records before the 20th in one batch, rolled up; then a batch of the other days and
    of late records of two earlier days; the second refresh recomputes only what these touch."""
    path, states, rows = scratch_path(spark, "rollup-store"), scratch_path(spark, "rollup-states"), ekc(spark, sf)
    day = F.dayofmonth("HL_DATE")
    late = day.isin(3, 11) & (F.col("event_id") % 4 == 1)
    first = (day < 20) & ~late
    ledger.write_batch_published(rows.where(first), path, "first")
    rollups.refresh(spark, path, states, _KEYS, _COUNTERS)
    ledger.write_batch_published(rows.where(~first), path, "second")
    rollups.refresh(spark, path, states, _KEYS, _COUNTERS)
    grains = []
    for grain in ("hour", "day"):
        df = rollups.read_rollup(spark, path, states, grain)
        hour = F.col("pk_hr") if grain == "hour" else F.lit(None).cast("string")
        grains.append(df.select(F.lit(grain).alias("grain"), "pk_ft", "pk_date", "pk_market", hour.alias("pk_hr"), "cell", "n_rows",
                                *[c for name in _COUNTERS for c in rollups.finals(name)]))
    return finish(grains[0].unionByName(grains[1]))

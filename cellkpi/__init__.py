"""cellkpi — cell-counter KPI aggregation expressed as Spark DataFrame/SQL plans.

Layout:
  sources/    readers (delimited counters, lookup, store), schema registry, sinks
  operators/  enrichment join, spec-driven aggregation, partition selection
  functions/  column-level helpers (sort keys, sector layer, run ids, export keys)
  plans/      end-to-end jobs (ingest, report) and the driver-table catalogue
  streaming/  incremental landing and live hourly aggregation
"""

from cellkpi.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]

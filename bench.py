"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated choice of registered queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import local_session

HEADLINE = (
    "scd2_snapshot_close", "scd2_incremental", "scd2_composite_key", "scd2_null_key", "mart_current",
    "schema_evolution_versions", "latest_per_key", "record_text_key", "flatten_root", "flatten_child",
    "flatten_scalar_array", "flatten_props", "stable_parent_keys", "sync_batch", "assemble_pages",
    "page_completeness", "page_chain_audit", "manifest_validation", "high_water_mark", "ledger_dedup",
    "run_report", "run_states", "normalized_names", "dataset_stats", "warehouse_runs",
    "incremental_runs", "stream_scd2", "staging_roundtrip",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), name="tidemark-bench")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    # The session, its code paths and the file cache are warmed up once.
    QUERIES["latest_per_key"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()

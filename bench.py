"""Headline queries, timed; prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the number of local threads. A query
counts from building its plan (with the size checks that belong to it) to the last
row produced.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleanery.catalogue import all_queries  # noqa: E402
from gleanery.session import local_session  # noqa: E402

HEADLINE = [
    "export_flat",
    "export_with_metadata",
    "export_dataset_docs",
    "export_af_docs",
    "page_scan",
    "progress",
    "metadata_split",
    "upsert_metadata",
    "upsert_data",
    "upsert_uuid_conflict",
    "incremental_run",
    "quarantine_casts",
    "error_log",
    "run_counters",
    "purge_import",
    "code_lookup_default",
    "get_or_insert_dims",
    "load_fact",
    "load_metadata",
    "bridge_territories",
    "actor_bridges",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = all_queries()
    spark.read.parquet(f"{folder}/orders.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

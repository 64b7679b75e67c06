"""Time the headline queries (best of the runs); print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "incremental_strict", "incremental_query", "bootstrap_slice", "coerce_integer", "coerce_string",
    "coerce_timestamp", "normalize_warn", "normalize_ragged", "drift_report", "infer_schema_types",
    "merge_upsert", "merge_lineitem", "merge_missing_column", "dedupe_last", "dedupe_newest",
    "load_append", "load_merge", "load_merge_buckets", "incremental_load", "stream_merge",
    "partition_time_day", "windows_counts", "window_account_progress", "record_path", "record_path_edges",
    "flatten_map", "measure_label_join", "parent_child", "page_audit_cursor", "state_upsert",
    "runs_streams", "csv_all_string", "files_mixed", "log_redact_documents",
]


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                      "runs": RUNS}))


if __name__ == "__main__":
    main()

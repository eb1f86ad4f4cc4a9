"""Times the headline queries at `$BENCH_SF_DIR` on `local[$BENCH_CPUS]` and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tidemark import catalog
from tidemark.session import build_session

HEADLINE = (
    "dedupe_report", "chunk_files", "new_chunks", "file_documents", "reassemble", "sync_totals", "detect_changes",
    "change_summary", "next_batch", "upsert_docs", "scope_filter", "scope_verdict", "search", "search_all",
    "resolve", "latest_write", "sync_with_merge", "merge_text", "merge_markdown", "merge_json", "merge_json_leaves",
    "merge_conflicts", "retain_version_rows", "version_history", "pull", "push_chunks", "retry_backlog",
    "assign_batches", "audit_lines", "retain_audit", "run_calendar", "match_schedules", "next_run_for",
    "changes_per_run", "debounce", "route_events", "debounce_stream", "apply_remote", "push_documents", "pull_report",
    "sync_documents", "sync_then_pull", "follow_remote", "follow_local", "pull_few_folders", "detect_changes_tree", "store_sketch",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # start the executors before the clock
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()

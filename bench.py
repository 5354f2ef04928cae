"""Headline queries at one scale; prints one JSON line.

Each query is run once to warm up the JVM and once timed, written to the ``noop`` sink so
that all columns of all rows are computed. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and
``BENCH_QUERIES`` (comma-separated, or ``all``) override the defaults.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "list_status",
    "status_line",
    "estimate_remaining",
    "start_gaps",
    "start_gap_quantile",
    "snapshot_changes",
    "latest_attempt",
    "order_jobs",
    "attach_runinfo",
    "attach_resubmission_of",
    "config_roots",
    "attempt_history",
    "plan_resubmit_configs",
    "replace_jobs",
    "report_totals",
    "job_table",
    "runinfo_log",
    "parse_squeue",
    "parse_sacct",
    "parse_bjobs_wide",
    "parse_scontrol",
    "split_records",
    "split_text_records",
    "batch_to_configs",
    "read_job_lists",
    "read_runinfo",
    "stream_queue_changes",
]


def main() -> None:
    from batchledger.session import build_session
    from batchledger.workload.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),  # one process: local is shared
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()

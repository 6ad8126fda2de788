"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]; every result
is fully computed through the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from quillsieve.catalog import load
from quillsieve.session import build_session

HEADLINE = (
    "p1_curated_conversations",
    "p1_full_run",
    "p3_assessment",
    "c2_schema_check",
    "c5_filter_reasons",
    "c8_quality_gate",
    "c12_multi_dimension_filter",
    "e8_diversity_score",
    "f3_basic_statistics",
    "f3a_histogram",
    "f5_numeric_diversity",
    "f6_usage_metrics",
    "f7_assessment_report",
    "f10_evaluation_metrics",
    "g8_near_duplicates",
    "h1_balanced_selection",
    "h6_round_robin_plan",
    "h7_request_history",
    "i3_exact_duplicates",
    "a1_jsonl_scan",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    queries["c8_quality_gate"](spark, folder).write.format("noop").mode("overwrite").save()  # untimed: engine start
    times = {}
    for name in names:
        started = time.monotonic()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: run the headline marts at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians), "unit",
"queries": {name: median seconds}, "sf", "runs", "settings"}. Each query is
run once to warm up, then ``BENCH_RUNS`` (default 3) times, fully executed
by a no-op write (the ``noop`` sink materialises every row, no collect).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martforge.plans import catalog  # noqa: E402
from martforge.session import get_session  # noqa: E402

# Headline queries: every mart plus the heavier operator-level keys. The
# load-policy and streaming keys are left out (they measure file-system
# commits, not query work).
HEADLINE = [
    "conclusions_summary", "unit_summary", "describe_time_daily", "distinct_conclusions",
    "oncology_counts", "overdue_monitoring", "benefit_cohort", "undescribed_queue", "equipment_studies",
    "ai_use_series", "ai_use_by_model", "ai_use_by_study", "model_usage_daily", "freshness_report",
    "refresh_log", "clean_comments", "accession_sync", "dismissed_guide", "web_registry",
    "duplicate_audit", "keep_latest_ties", "status_chain", "value_at_first", "best_effort_parse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", cpus * 2, app_name="martforge-bench")
    spark.conf.set("spark.sql.shuffle.partitions", str(cpus * 2))
    times = {}
    for name in only or HEADLINE:
        fn = catalog.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "settings": {"master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus * 2,
                     "aqe": spark.conf.get("spark.sql.adaptive.enabled")},
    }))


if __name__ == "__main__":
    main()

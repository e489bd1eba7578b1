"""Benchmark the headline reports.

Runs each headline query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints ONE JSON line:

    {"metric": "...", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (every row
computed, nothing collected to the driver); the figure per query is the
median of ``$BENCH_REPEAT`` warm runs (default 3) after one warm-up run;
``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regscope.queries import QUERIES  # noqa: E402
from regscope.session import build_session  # noqa: E402

HEADLINE = [
    "most_recent_log",
    "reporting_historic_endpoints",
    "reporting_latest_endpoints",
    "historic_endpoints_registry",
    "latest_endpoints_registry",
    "issue_counts",
    "column_field_summary",
    "endpoint_summary",
    "reporting_data",
    "resource_summary",
    "issue_type_summary",
    "provision_summary",
    "resource_catalogue",
    "duplicate_issues",
    "consolidate_source",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    keys = only or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="regscope-bench")
    times: dict[str, float | None] = {}
    for k in keys:
        q = QUERIES[k]
        try:
            _run(q(spark, sf_dir))  # warm-up (JIT, file listing cache)
            runs = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                _run(q(spark, sf_dir))
                runs.append(time.perf_counter() - t0)
            times[k] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the others
            print(f"bench: {k} failed: {type(e).__name__}: {str(e)[:300]}", file=sys.stderr)
            times[k] = None
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({
        "metric": "sum of median seconds over headline registry reports",
        "value": round(sum(v for v in times.values() if v is not None), 4),
        "unit": "sec",
        "queries": times,
        "sf": sf,
    }))


if __name__ == "__main__":
    main()

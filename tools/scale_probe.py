"""Scaling probe: the log-driven reports over the sf0.1 fixture log and over
a 10x log (the fixture log unioned with nine year-shifted copies of itself),
to check that time grows at most linearly with the log.

Usage: python tools/scale_probe.py [sf_dir] [factor]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from regscope.fixtures import Fixtures  # noqa: E402
from regscope.plans import performance as perf  # noqa: E402
from regscope.plans import registry as reg  # noqa: E402
from regscope.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    factor = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session("local[8]", 8)
    t = dict(Fixtures.of(spark, sf).registry_tables())
    log = t["log"]

    def copies(n):
        out = None
        for i in range(n):
            c = log if n == 1 else log.withColumn(
                "entry_date", F.concat(F.lit(str(2000 + i)), F.substring("entry_date", 5, 100)))
            out = c if out is None else out.unionByName(c)
        return out

    def provision(tables):
        hist = reg.historic_endpoints(tables, "reporting")
        pr = perf.provision_reporting(perf.provision_data(tables["provision"], tables["organisation"]),
                                      perf.reporting_data(hist))
        return perf.provision_summary(pr, perf.issue_counts(tables["issue"], tables["resource"], tables["issue_type"]))

    reports = {"historic": lambda tb: reg.historic_endpoints(tb, "reporting"),
               "latest": lambda tb: reg.latest_endpoints(tb, "reporting"),
               "most_recent_log": lambda tb: reg.most_recent_log(tb["log"]),
               "provision_summary": provision}
    for n in (1, factor):
        t["log"] = copies(n)
        rows = t["log"].count()
        for name, build in reports.items():
            build(t).write.format("noop").mode("overwrite").save()
            best = min(_timed(lambda: build(t).write.format("noop").mode("overwrite").save()) for _ in range(2))
            print(f"x{n} log rows {rows}: {name} {best:.2f}s")
    spark.stop()


def _timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


if __name__ == "__main__":
    main()

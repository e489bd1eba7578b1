"""Time the plan alternatives SURVEY section 4 asks about, and check each pair agrees.

Usage: python tools/plan_variants.py [sf_dir]

* R4 historic endpoints: log aggregated before the star join (shipped) vs
  the star join of raw log rows grouped afterwards.
* R1 most recent log: partial max + equi-join (shipped) vs max() over a
  window partitioned by endpoint.
* R13 provision summary: two-level aggregate (shipped) vs COUNT(DISTINCT)
  (planned with Expand).
"""

from __future__ import annotations

import hashlib
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from regscope.fixtures import Fixtures  # noqa: E402
from regscope.functions.dates import date_part, sql_day  # noqa: E402
from regscope.operators.aggregates import drop_null_keys  # noqa: E402
from regscope.operators.joins import null_safe_left_join  # noqa: E402
from regscope.plans import performance as perf  # noqa: E402
from regscope.plans import registry as reg  # noqa: E402
from regscope.session import build_session  # noqa: E402


def raw_dims(t):
    """Dimensions as they are (no reduction to the report grain)."""
    e = t["endpoint"].select("endpoint", "endpoint_url", F.col("entry_date").alias("e_entry_date"),
                             F.col("end_date").alias("e_end_date"))
    r = t["resource"].select(F.col("resource").alias("__res"), F.col("start_date").alias("r_start_date"),
                             F.col("end_date").alias("r_end_date"))
    return reg.endpoint_sources(t["source"], t["source_pipeline"], t["organisation"]), e, r


def r4_direct(t):
    es, e, r = raw_dims(t)
    j = (t["log"].join(es, "endpoint").join(e, "endpoint")
         .join(r, F.col("resource") == r["__res"], "left"))
    keys = ["organisation", "name", "pipeline", "collection", "endpoint", "endpoint_url", "documentation_url",
            "licence", "status", "exception", "resource"]
    g = j.groupBy(*keys).agg(F.max(F.struct("entry_date", "e_entry_date", "e_end_date", "r_start_date",
                                            "r_end_date")).alias("m"))
    return g.select(
        "organisation", "name", F.col("name").alias("organisation_name"), F.col("pipeline").alias("dataset"),
        "collection", "pipeline", "endpoint", "endpoint_url", "documentation_url", "licence",
        F.col("status").alias("latest_status"), F.col("exception").alias("latest_exception"), "resource",
        date_part("m.entry_date").alias("latest_log_entry_date"),
        date_part("m.e_entry_date").alias("endpoint_entry_date"),
        date_part("m.e_end_date").alias("endpoint_end_date"),
        date_part("m.r_start_date").alias("resource_start_date"),
        date_part("m.r_end_date").alias("resource_end_date"))


def r1_window(log):
    d = log.withColumn("__day", sql_day("entry_date"))
    w = d.withColumn("__max", F.max("__day").over(Window.partitionBy("endpoint")))
    return w.where(F.col("__day") == F.col("__max")).select(*log.columns)


def r13_count_distinct(prov_rep, issues):
    keys = ["organisation", "organisation_name", "dataset", "provision_reason", "provision_end_date"]
    m = null_safe_left_join(drop_null_keys(prov_rep, keys), issues, [("resource", "resource"), ("dataset", "dataset")])
    active = F.coalesce(F.col("endpoint_end_date"), F.lit("")) == ""
    sums = [F.coalesce(F.sum(F.when((F.col("severity") == s) & (F.col("responsibility") == r) & active,
                                    F.col("count_issues"))), F.lit(0)).cast("bigint").alias(f"count_issue_{s}_{r}")
            for s, r in perf.ISSUE_CLASSES]
    return m.groupBy(*keys).agg(
        F.count_distinct(F.when(active, F.col("endpoint"))).alias("active_endpoint_count"),
        F.count_distinct(F.when(active & ~F.col("latest_status").eqNullSafe("200"), F.col("endpoint")))
        .alias("error_endpoint_count"), *sums).select(*perf.EXPECTED_COLUMNS["provision_summary"])


def _digest(df):
    cols = sorted(df.columns)
    lines = sorted("|".join(str(r[c]) for c in cols) for r in df.collect())
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()[:12]


def _time(build, repeat=3):
    build().write.format("noop").mode("overwrite").save()
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    fx = Fixtures.of(spark, sf)
    t = fx.registry_tables()

    def prov_parts():
        hist = reg.historic_endpoints(t, "reporting")
        pr = perf.provision_reporting(perf.provision_data(t["provision"], t["organisation"]),
                                      perf.reporting_data(hist))
        return pr, perf.issue_counts(t["issue"], t["resource"], t["issue_type"])

    pairs = {
        "R4 pre-aggregated log vs direct star": (lambda: reg.historic_endpoints(t, "reporting"), lambda: r4_direct(t)),
        "R1 max+join vs window": (lambda: reg.most_recent_log(t["log"]), lambda: r1_window(t["log"])),
        "R13 two-level vs count(distinct)": (lambda: perf.provision_summary(*prov_parts()),
                                              lambda: r13_count_distinct(*prov_parts())),
    }
    for name, (shipped, other) in pairs.items():
        same = _digest(shipped()) == _digest(other())
        print(f"{name}: shipped {_time(shipped)}s, alternative {_time(other)}s, same result: {same}")
    spark.stop()


if __name__ == "__main__":
    main()

"""A hot key holding a third of the log, with broadcasts disabled (every join a
shuffle join) and AQE's skew thresholds lowered so that any skewed partition
would be split: results are unchanged, and the plans never need a split —
``most_recent_log`` joins on (endpoint, day), spreading a hot endpoint over its
days, and the endpoint reports join the already aggregated log."""

import pytest
from pyspark.sql import functions as F

from regscope.fixtures import Fixtures
from regscope.plans import registry as reg

SF = "/root/testdata/sf0.001"
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    fx = Fixtures.of(spark, SF)
    hot = fx.endpoint.select(F.min("endpoint")).first()[0]
    log = fx.log.withColumn("endpoint", F.when(F.abs(F.hash("entry_date", "resource", "status")) % 3 == 0,
                                               F.lit(hot)).otherwise(F.col("endpoint")))
    tables = dict(fx.registry_tables())
    tables["log"] = log
    return tables, hot


def _run(spark, build, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = build()
        out = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    return out, plan


def test_hot_endpoint_most_recent_log(spark, skewed):
    tables, hot = skewed
    share = tables["log"].where(F.col("endpoint") == hot).count() / tables["log"].count()
    assert share > 0.3
    normal, _ = _run(spark, lambda: reg.most_recent_log(tables["log"]), {})
    split, plan = _run(spark, lambda: reg.most_recent_log(tables["log"]), SKEW_CONF)
    assert split == normal
    assert "SortMergeJoin [endpoint" in plan and "__day" in plan.split("SortMergeJoin [")[1].split("]")[0]
    assert "isSkewJoin=true" not in plan


def test_hot_endpoint_spreads_over_days(spark, skewed):
    from pyspark.sql.functions import spark_partition_id
    from regscope.functions.dates import sql_day
    tables, hot = skewed
    keyed = tables["log"].select("endpoint", sql_day("entry_date").alias("__day")).repartition(8, "endpoint", "__day")
    sizes = [r[1] for r in keyed.groupBy(spark_partition_id()).count().collect()]
    assert max(sizes) < 0.3 * sum(sizes)   # no partition holds the hot endpoint's third


def test_hot_endpoint_reports(spark, skewed):
    tables, _ = skewed
    for build in (lambda: reg.historic_endpoints(tables, "reporting"),
                  lambda: reg.latest_endpoints(tables, "reporting", as_of="2003-01-01T00:00:00Z")):
        normal, _ = _run(spark, build, {})
        split, plan = _run(spark, build, SKEW_CONF)
        assert split == normal
        assert "isSkewJoin=true" not in plan

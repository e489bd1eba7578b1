"""Historic/latest endpoint reports with duplicate keys in every dimension,
against a brute-force model: join the raw log to the raw dimensions and group
the joined rows on the report key (greatest tuple for the bare columns)."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from conftest import rows
from regscope.functions.dates import date_part
from regscope.functions.keys import explode_list
from regscope.operators.aggregates import top_by
from regscope.plans import registry as reg

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from plan_variants import raw_dims, r4_direct  # noqa: E402

AS_OF = "2022-01-01T00:00:00Z"


@pytest.fixture(scope="module")
def t(spark):
    S = "string"
    mk = lambda data, cols: spark.createDataFrame(data, ", ".join(f"{c} {S}" for c in cols))
    source = mk([("s1", "local-authority-eng:A", "c1", "e1", "ogl", "d1", "tree"),
                 ("s1b", "local-authority-eng:A", "c1", "e1", "ogl", "d1", "tree;area"),
                 ("s2", "local-authority:A", "c2", "e2", "", "d2", "tree")],
                ["source", "organisation", "collection", "endpoint", "licence", "documentation_url", "pipelines"])
    return {
        "organisation": mk([("local-authority:A", "Alpha", "ds-a"), ("local-authority:A", "Alpha", "ds-x")],
                           ["organisation", "name", "dataset"]),
        "source": source,
        "source_pipeline": explode_list(source, "pipelines", "pipeline", keep=["source"]),
        "endpoint": mk([("e1", "u1", "2020-01-01T00:00:00Z", ""), ("e1", "u1", "2020-03-01T00:00:00Z", ""),
                        ("e1", "u1", "2020-05-01T00:00:00Z", "2021-01-01"), ("e1", "u1b", "2019-01-01T00:00:00Z", ""),
                        ("e2", "u2", "2020-02-01T00:00:00Z", "")],
                       ["endpoint", "endpoint_url", "entry_date", "end_date"]),
        "log": mk([("e1", "2021-01-01T10:00:00Z", "200", "", "r1"), ("e1", "2021-01-02T10:00:00Z", "200", "", "r1"),
                   ("e1", "2021-01-03T10:00:00Z", "404", "", ""), ("e2", "2021-02-01T00:00:00Z", "200", "", "r2"),
                   ("e2", "2021-02-01T00:00:00Z", "200", "", "r1")],
                  ["endpoint", "entry_date", "status", "exception", "resource"]),
        "resource": mk([("r1", "2020-01-01", "", "e1"), ("r1", "2020-06-01", "2021-01-01", "e1"),
                        ("r2", "2020-02-01", "", "e2")], ["resource", "start_date", "end_date", "endpoints"]),
    }


def test_historic_reporting_matches_direct(t):
    assert rows(reg.historic_endpoints(t, "reporting")) == rows(r4_direct(t))


def test_historic_registry_matches_direct(t):
    es, e, r = raw_dims(t)
    j = (t["log"].join(es, "endpoint").join(e, "endpoint").join(r, F.col("resource") == r["__res"], "left")
         .withColumn("organisation_name", F.col("name")).withColumn("dataset", F.col("org_dataset")))
    keys = ["organisation", "name", "organisation_name", "dataset", "collection", "pipeline", "endpoint",
            "endpoint_url", "licence", "status", "exception", "resource"]
    g = top_by(j, keys, order=["entry_date", "e_entry_date", "e_end_date", "r_start_date", "r_end_date"])
    direct = g.select(*keys, F.col("entry_date").alias("latest_log_entry_date"),
                      F.col("e_entry_date").alias("endpoint_entry_date"),
                      F.col("e_end_date").alias("endpoint_end_date"),
                      F.col("r_start_date").alias("resource_start_date"),
                      F.col("r_end_date").alias("resource_end_date"))
    got = reg.historic_endpoints(t, "registry")
    assert got.columns == direct.columns
    assert rows(got) == rows(direct)
    assert {r["dataset"] for r in got.collect()} == {"ds-a", "ds-x"}


def test_latest_reporting_matches_direct(t):
    es, e, r = raw_dims(t)
    d200 = reg.days_since_200(t["log"], AS_OF)
    j = (t["log"].join(es, "endpoint").join(e.where(F.col("e_end_date") == ""), "endpoint")
         .join(d200, "endpoint", "left").join(r, F.col("resource") == r["__res"], "left")
         .withColumn("organisation_name", F.col("name")).withColumn("dataset", F.col("pipeline")))
    keys = ["organisation", "name", "organisation_name", "dataset", "collection", "pipeline", "endpoint",
            "endpoint_url", "licence", "status", "days_since_200", "exception"]
    g = top_by(j.withColumnRenamed("entry_date", "latest"), keys,
               order=["latest", "resource", "e_entry_date", "e_end_date", "r_start_date", "r_end_date"])
    order = ["e_entry_date", "latest", "endpoint", "status", "exception", "collection", "licence", "name",
             "dataset", "endpoint_url", "days_since_200", "resource", "e_end_date", "r_start_date", "r_end_date"]
    top = top_by(g, ["organisation", "pipeline"], order=order, payload=["organisation_name"])
    direct = top.select("organisation", "pipeline", "endpoint", "endpoint_url", F.col("status"), "resource",
                        date_part("e_entry_date").alias("endpoint_entry_date"), "days_since_200")
    got = reg.latest_endpoints(t, "reporting", as_of=AS_OF).select(
        "organisation", "pipeline", "endpoint", "endpoint_url", F.col("latest_status").alias("status"), "resource",
        "endpoint_entry_date", "days_since_200")
    assert rows(got) == rows(direct)

"""What keeps a report's memory, shuffles and broadcasts in bounds on large tables: plans
and helpers that the reports' rows alone do not show."""

import os
import re

from pyspark.sql import functions as F

from conftest import rows
from regscope import sinks
from regscope.fixtures import Fixtures
from regscope.operators.setops import repeat_rows
from regscope.plans import catalogue as cat
from regscope.plans import performance as perf
from regscope.plans import registry as reg
from regscope.sources import csv as C
from regscope.sources.blocks import read_lines
from test_reports_golden import t  # noqa: F401


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_resources_are_never_broadcast(spark, t, scratch):  # noqa: F811
    # small files of texts: their statistics would let the planner broadcast them
    def stored(name, df):
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    resource = stored("resource", t["resource"])
    fields = stored("column_field", spark.createDataFrame([("r1", "tree", "Name", "name")], "resource string, dataset string, column string, field string"))
    cf = perf.column_field_summary(fields, resource)
    assert "Broadcast" not in _plan(cf)
    prov = stored("prov", spark.createDataFrame([tuple("r1" if c == "resource" else "tree" if c == "dataset" else "x" for c in perf.EXPECTED_COLUMNS[
        "endpoint_dataset_resource_summary"][:12])], ", ".join(f"{c} string" for c in perf.EXPECTED_COLUMNS["endpoint_dataset_resource_summary"][:12])))
    out = perf.resource_summary(prov, cf)
    assert "Broadcast" not in _plan(out)
    assert rows(out, "mapping_field", "non_mapping_field") == [("name", None)]


def test_star_counts_alike_dimension_rows(spark):
    def mk(data, cols):
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    blank = [("", "a-eng:1", f"e{i % 2}", "c", None, "d") for i in range(6)]
    tables = {
        "source": mk(blank, ["source", "organisation", "endpoint", "collection", "licence", "documentation_url"]),
        "source_pipeline": mk([("", "tree")] * 5 + [("", "area"), ("", None), (None, "x")], ["source", "pipeline"]),
        "organisation": mk([("a:1", "n", "ds")] * 2, ["organisation", "name", "dataset"]),
        "endpoint": mk([("e0", "u", "s", ""), ("e0", "u", "s", ""), ("e1", "u", "s", "")], ["endpoint", "endpoint_url", "entry_date", "end_date"]),
        "log": mk([("e0", "d1", "200", "", "r"), ("e1", "d2", "", "", None)], ["endpoint", "entry_date", "status", "exception", "resource"])}
    star = reg.log_star(tables)
    # sources x pipelines x organisations x endpoint rows
    assert {tuple(r): r["count"] for r in star.groupBy("endpoint", "pipeline").count().collect()} == {
        ("e0", "tree", 60): 60, ("e0", "area", 12): 12, ("e0", None, 12): 12, ("e1", "tree", 30): 30, ("e1", "area", 6): 6, ("e1", None, 6): 6}
    assert "explode(sequence" in _plan(star)


def test_rows_that_come_very_often_are_copied_whole(spark):
    times = [0, 1, 2, 63, 64, 65, 128, 200, None, -3, 5000]
    data = [(f"k{i}", None if i % 2 else "x" * i, n) for i, n in enumerate(times)] + [("k1", None, 3), ("k1", None, 70)]
    out = repeat_rows(spark.createDataFrame(data, "`a.b` string, c string, n long"), "n")
    assert out.columns == ["a.b", "c"]
    want = {}
    for a, c, n in data:
        if n is not None and n > 0:
            want[a, c] = want.get((a, c), 0) + n
    assert {(r[0], r[1]): r["count"] for r in out.groupBy("`a.b`", "c").count().collect()} == want
    assert out.count() == sum(want.values())
    # no column of a copy is written by itself, and no row is moved for it
    plan = _plan(out)
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Exchange" not in plan
    assert "CartesianProduct" in _plan(reg.log_star({
        "source": spark.createDataFrame([("", "a-eng:1", "e", "c", None, "d")] * 80, "source string, organisation string, endpoint string, collection string, licence string, documentation_url string"),
        "source_pipeline": spark.createDataFrame([("", "tree")] * 80, "source string, pipeline string"),
        "organisation": spark.createDataFrame([("a:1", "n", "ds")], "organisation string, name string, dataset string"),
        "endpoint": spark.createDataFrame([("e", "u", "s", "")], "endpoint string, endpoint_url string, entry_date string, end_date string"),
        "log": spark.createDataFrame([("e", "d1", "200", "", "r")], "endpoint string, entry_date string, status string, exception string, resource string")}))


def test_reports_of_one_row_an_endpoint_reduce_the_log_first(t):  # noqa: F811
    historic = reg.historic_endpoints(t, "reporting")
    assert rows(perf.reporting_data(perf.reporting_historic(t)).select(F.to_json(F.struct("*")))) == rows(
        perf.reporting_data(historic).select(F.to_json(F.struct("*"))))
    assert rows(perf.endpoint_summary(perf.active_historic(t)).select(F.to_json(F.struct("*")))) == rows(
        perf.endpoint_summary(historic).select(F.to_json(F.struct("*"))))
    assert sorted(r["endpoint"] for r in reg.latest_of_endpoints(t["log"]).collect()) == ["e1", "e2", "e3", "e4"]
    summary = reg.log_summary(t["log"])
    assert rows(reg.latest_of_endpoints(summary, "latest")) == rows(reg.latest_of_endpoints(t["log"]))


def test_views_are_dealt_out_by_size(spark, scratch, monkeypatch):
    df = spark.range(5000).select((F.col("id") + 1).alias("p_partkey"), F.lit("green").alias("p_name"), F.lit(10).alias("p_size"))
    df.coalesce(1).write.parquet(f"{scratch}/part.parquet")
    import regscope.fixtures as X
    monkeypatch.setattr(X, "SPREAD_BYTES", 100)
    fx = Fixtures(spark, scratch)
    parts = fx.spread("part", ["p_partkey", "p_size"]).rdd.getNumPartitions()
    assert parts > 50 > spark.sparkContext.defaultParallelism


def test_issues_are_dealt_out_before_they_are_grouped(spark, scratch, monkeypatch):
    ids = spark.range(5000)
    ids.select(F.col("id").alias("o_orderkey"), (F.col("id") % 700).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
               (F.col("id") / 4).alias("o_totalprice"), F.when(F.col("id") % 9 > 0, "1-URGENT").alias("o_orderpriority"),
               ).coalesce(1).write.parquet(f"{scratch}/orders.parquet")
    import regscope.fixtures as X
    monkeypatch.setattr(X, "SPREAD_BYTES", 100)
    fx = Fixtures(spark, scratch)
    dealt = fx.registry_tables()["issue"]
    assert dealt.rdd.getNumPartitions() > 50
    as_text = F.to_json(F.struct("*"))
    assert rows(dealt.select(as_text)) == rows(fx.issue.select(as_text))


def test_rows_of_a_blank_resource_are_few_before_they_meet_ended_ones(spark):
    log = ([("e1", f"2020-01-{i % 28 + 1:02d}T00:00:00Z", "", "Timeout", "") for i in range(500)] +
           [("e1", "2020-03-01T00:00:00Z", "200", "", "gone"), ("e1", "2020-02-01T00:00:00Z", "200", "", "r"),
            ("e2", "2020-01-05T00:00:00Z", "200", "", "gone"), ("e2", "2020-01-04T00:00:00Z", "404", "", None),
            ("e2", "2020-01-04T00:00:00Z", None, "x", None), ("e3", "2020-01-04T00:00:00Z", "200", "", "gone"),
            ("e4", None, "200", "", "r"), ("e4", None, "404", "", "r"), (None, "2020-01-01T00:00:00Z", "200", "", "r")])
    log = spark.createDataFrame(log, "endpoint string, entry_date string, status string, exception string, resource string")
    resource = spark.createDataFrame([("gone", "2020-01-01", "2021-01-01"), ("r", "2020-01-01", ""), (None, "2020-01-01", "2021-01-01")],
                                     "resource string, start_date string, end_date string")
    ended = reg.ended_resources(resource)
    want = {("e1", "200", "", "r", "2020-02-01T00:00:00Z"), ("e2", "404", "", None, "2020-01-04T00:00:00Z"),
            ("e4", "404", "", "r", None), (None, "200", "", "r", "2020-01-01T00:00:00Z")}
    latest = reg.latest_of_endpoints(log, ended=ended)
    assert {tuple(r) for r in latest.collect()} == want and latest.count() == 4
    summed = reg.latest_of_endpoints(reg.log_summary(log), "latest", ended)
    assert {tuple(r) for r in summed.collect()} == want
    # whatever the optimizer does, the join takes rows of an endpoint and resource, not those of the log
    plan = _plan(latest).split("SortMergeJoin")[1]
    assert "SortAggregate(key=[endpoint#" in plan.split("Scan")[0] and ", resource#" in plan.split("SortAggregate(key=[endpoint#")[1].split("]")[0]


def test_views_are_dealt_out_by_rows(spark, scratch, monkeypatch):
    # rows that are stored in next to no bytes
    df = spark.range(20000).select((F.col("id") * 0 + 1).alias("p_partkey"), F.lit(10).alias("p_size"))
    df.coalesce(1).write.parquet(f"{scratch}/part.parquet")
    import regscope.fixtures as X
    monkeypatch.setattr(X, "SPREAD_ROWS", 300)
    parts = Fixtures(spark, scratch).spread("part", ["p_partkey", "p_size"]).rdd.getNumPartitions()
    assert parts == 67 > spark.sparkContext.defaultParallelism


def test_a_file_of_many_row_groups_is_read_in_parts(spark, scratch, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq
    keys = [None if i % 9 == 0 else i // 2 for i in range(20000)]
    pq.write_table(pa.table({"p_partkey": pa.array(keys, pa.int64()), "p_size": pa.array([10] * 20000, pa.int32())}), f"{scratch}/part.parquet", row_group_size=100)
    import regscope.fixtures as X
    monkeypatch.setattr(X, "SPREAD_ROWS", 300)
    fx = Fixtures(spark, scratch)
    df = fx.spread("part", ["p_partkey", "p_size"])
    assert "Exchange" not in _plan(df) and 50 < df.rdd.getNumPartitions() < 100
    assert df.sparkSession._jsparkSession.equals(spark._jsparkSession)  # its settings hold
    assert df.count() == 20000
    assert rows(df.where("p_partkey is not null")) == sorted((k, 10) for k in keys if k is not None)
    # rows of a row group too large for a task are dealt out
    monkeypatch.setattr(X, "SPREAD_ROWS", 40)
    assert "Exchange" in _plan(Fixtures(spark, scratch).spread("part", ["p_partkey", "p_size"]))


def test_reports_share_the_log_as_it_was_summed_and_moved(spark, t):  # noqa: F811
    summary = reg.log_summary(t["log"])
    alone = perf.build_performance(t, "2022-01-01T00:00:00Z")
    shared = perf.build_performance(t, "2022-01-01T00:00:00Z", summary)
    for name, df in shared.items():
        assert rows(df.select(F.to_json(F.struct("*")))) == rows(alone[name].select(F.to_json(F.struct("*")))), name
    # the summary goes to ended resources as it is: not gathered by endpoint and resource once more
    plan = _plan(shared["endpoint_dataset_summary"])
    assert not re.search(r"hashpartitioning\(endpoint#\d+, resource#\d+", plan)


def test_many_small_blocks_are_few_tasks(spark, scratch):
    path = f"{scratch}/a.csv"
    with open(path, "w") as f:
        f.write("a,b\n" + "".join(f'{i},"x\n{i}"\n' for i in range(4000)))
    lines = read_lines(spark, path, 512)
    assert lines.select("block").distinct().count() > 50
    assert len(lines.inputFiles()) <= spark.sparkContext.defaultParallelism
    got = C.read_csv_text(spark, path, block_bytes=512)
    assert rows(got) == sorted((str(i), f"x\n{i}") for i in range(4000))


def test_rows_are_not_moved_to_meet_their_header(spark, scratch):
    for i, columns in enumerate(("a,b", "b,a")):
        os.makedirs(f"{scratch}/{i}")
        with open(f"{scratch}/{i}/t.csv", "w") as f:
            f.write(columns + "\n1,2\n")
    df = C.read_csv_union(spark, f"{scratch}/*/t.csv")
    assert rows(df) == [("1", "2"), ("2", "1")]
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_manifest_rows_are_dealt_out_before_they_are_compared(spark):
    d = spark.createDataFrame([("d", "c"), ("d", "c"), ("e", None)], "dataset string, collection string")
    out = cat.dataset_manifest(d, "2022-01-01T00:00:00Z")
    assert out.count() == 5
    assert "REBALANCE" in _plan(out)


def test_landed_files_are_bounded(spark, scratch):
    path = sinks.write_csv(spark.range(100).coalesce(1), ["id"], f"{scratch}/x.csv", rows_per_file=30)
    from regscope import queries
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 4 and queries.ROWS_PER_FILE <= 1_000_000


def test_running_sum_of_blocks_of_one_position(spark):
    from regscope.operators.scan import running_sum

    df = spark.createDataFrame([(i, 1) for i in range(5)], "at long, n long")
    assert rows(running_sum(df, "at", "n", "before", width=1), "at", "before") == [(i, i) for i in range(5)]

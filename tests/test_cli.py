"""The command line over a tiny registry laid out as the reference lays it out."""

import os

from conftest import rows
from regscope.__main__ import main
from regscope.sources.csv import read_csv_text


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_cli_passes(spark, scratch):
    d = scratch
    _write(f"{d}/specification/schema-field.csv", "schema,field\nlog,endpoint\nlog,resource\nlog,status\n"
                                                   "log,exception\nlog,entry-date\n")
    _write(f"{d}/var/collection/c1/log.csv", "endpoint,entry-date,status,resource\ne1,2021-01-01T10:00:00Z,200,r1\n")
    _write(f"{d}/var/collection/c2/log.csv", "resource,status,endpoint,entry-date,exception\n,,e2,2021-02,x\n")
    assert main(["consolidate", "log", f"{d}/collection/log.csv", f"{d}/var/collection/c1/log.csv",
                 f"{d}/var/collection/c2/log.csv", "--schema-field", f"{d}/specification/schema-field.csv"]) == 0
    log = read_csv_text(spark, f"{d}/collection/log.csv")
    assert log.columns == ["endpoint", "resource", "status", "exception", "entry-date"]
    assert rows(log) == [("e1", "r1", "200", "", "2021-01-01T10:00:00Z"), ("e2", "", "", "x", "2021-02-01T00:00:00Z")]

    _write(f"{d}/collection/source.csv", "source,organisation,collection,endpoint,licence,documentation-url,pipelines\n"
                                         "s1,local-authority-eng:A,c1,e1,ogl,doc,tree\n")
    _write(f"{d}/collection/endpoint.csv", "endpoint,endpoint-url,entry-date,end-date\ne1,u1,2020-01-01T00:00:00Z,\n")
    _write(f"{d}/collection/resource.csv", "resource,start-date,end-date,endpoints\nr1,2020-01-01,,e1\n")
    _write(f"{d}/var/cache/organisation.csv", "organisation,name,dataset\nlocal-authority:A,Alpha,ds\n")
    _write(f"{d}/specification/provision.csv", "organisation,dataset,cohort,project,provision-reason,end-date\n"
                                               "local-authority:A,tree,c,,statutory,\n")
    _write(f"{d}/specification/issue-type.csv", "issue-type,severity,responsibility\nmissing,error,external\n")
    _write(f"{d}/var/issue/tree/abc1.csv", "row-number,field,issue-type\n1,geometry,missing\n")
    _write(f"{d}/var/column-field/tree/abc1.csv", "column,field\nWKT,geometry\n")
    assert main(["concat-issues", "--input-dir", f"{d}/var/issue", "--issues-dir", f"{d}/issues",
                 "--operational-issue-dir", f"{d}/performance/operational_issue"]) == 0
    assert main(["concat-column-field", "--input-dir", f"{d}/var/column-field",
                 "--column-field-dir", f"{d}/column-field"]) == 0
    common = ["--collection-dir", f"{d}/collection", "--specification-dir", f"{d}/specification",
              "--cache-dir", f"{d}/var/cache", "--issue-csv", f"{d}/issues/issue.csv",
              "--column-field-csv", f"{d}/column-field/column-field.csv"]
    registry, performance = ["--out", f"{d}/dataset/registry"], ["--out", f"{d}/dataset/performance"]
    _write(f"{d}/specification/specification.csv", "specification,name\nbrownfield,Brownfield land\n")
    _write(f"{d}/performance/operational_issue/operational-issue.csv",
           "dataset,resource,line-number,entry-number,field,issue-type,value,message,entry-date\n"
           "tree,abc1,3,3,reference,missing,,,2021-01-01\n")
    assert main(["build-registry", *common, *registry,
                 "--operational-issue-csv", f"{d}/performance/operational_issue/operational-issue.csv"]) == 0
    oi = spark.read.parquet(f"{d}/dataset/registry/operational_issue.parquet")
    assert dict(oi.dtypes)["line-number"] == "int"          # typed on load, kebab names kept
    assert rows(spark.read.parquet(f"{d}/dataset/registry/specification.parquet")) == [("brownfield", "Brownfield land")]
    assert main(["build-performance", *common, *performance]) == 0
    assert main(["check-performance", *common, *performance]) == 1   # reporting tables not built yet
    assert main(["build-reports", *common, *performance]) == 0
    assert main(["check-performance", *common, *performance]) == 0
    assert main(["check-performance", *common, *registry]) == 1      # registry variants lack the report columns
    ps = spark.read.parquet(f"{d}/dataset/performance/provision_summary.parquet")
    assert rows(ps, "organisation", "dataset", "active_endpoint_count", "count_issue_error_external") == [
        ("local-authority:A", "tree", 1, 0)]
    assert main(["resources", "--input-dir", f"{d}/collection", "--output", f"{d}/resources.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/resources.csv")) == [("c1", "tree", "r1")]


def test_cli_expectations(spark, scratch):
    d = scratch
    _write(f"{d}/specification/dataset.csv", "dataset,collection\ntree,trees\nbrand,\n")
    spark.createDataFrame([(1, "ok")], "n int, result string").write.parquet(f"{d}/var/expectations/tree.parquet")
    spark.createDataFrame([(2, 0.5)], "n bigint, score double").write.parquet(f"{d}/var/expectations/area.parquet")
    assert main(["expectations", "--spec-dir", f"{d}/specification", "--cache-dir", f"{d}/var/expectations",
                 "--output-dir", f"{d}/expectation"]) == 0
    man = read_csv_text(spark, f"{d}/expectation/manifest.csv")
    assert rows(man, "kind", "output_path") == [("expectation", "var/expectations/tree.parquet")]
    exp = read_csv_text(spark, f"{d}/expectation/expectation.csv")
    assert sorted(exp.columns) == ["n", "result", "score"]
    assert rows(exp, "n", "result", "score") == [("1", "ok", ""), ("2", "", "0.5")]


def test_cli_scripts(spark, scratch):
    d = scratch
    _write(f"{d}/var/issue/tree/aa.csv", "row-number,field,issue-type\n1,geometry,a\n2,name,b\n1,geometry,c\n")
    _write(f"{d}/var/issue/area/bb.csv", "row-number,field,issue-type\n1,geometry,a\n")
    assert main(["duplicate-issues", "--input-dir", f"{d}/var/issue", "--output", f"{d}/dup.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/dup.csv"), "pipeline", "resource", "issue-type") == [("tree", "aa", "c")]
    _write(f"{d}/collection/source.csv", "organisation,pipelines\nlocal-authority-eng:X,tree\ngovernment-organisation:Y,\n")
    assert main(["planning-authorities", "--source", f"{d}/collection/source.csv", "--output", f"{d}/lpa.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/lpa.csv")) == [("local-authority-eng:X",)]
    _write(f"{d}/var/cache/organisation.csv", "organisation,name\nlocal-authority:E1,A\n")
    _write(f"{d}/var/cache/geography.csv", "slug_id_label\n/area/1\n\n")
    assert main(["slugs", "--cache-dir", f"{d}/var/cache", "--output", f"{d}/slugs.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/slugs.csv")) == [("/area/1", "geography"),
                                                            ("/organisation/local-authority/E1", "organisation")]


def _registry(d):
    _write(f"{d}/collection/source.csv", "source,organisation,collection,endpoint,licence,documentation-url,pipelines\n"
                                         "s1,local-authority-eng:A,c1,e1,ogl,doc,tree\ns2,local-authority:A,c1,e2,,d2,tree;area\n")
    _write(f"{d}/collection/endpoint.csv", "endpoint,endpoint-url,entry-date,end-date\n"
                                           "e1,u1,2020-01-01T00:00:00Z,\ne2,u2,2020-02-01T00:00:00Z,\n")
    _write(f"{d}/collection/resource.csv", "resource,start-date,end-date,endpoints\nr1,2020-01-01,,e1\n")
    _write(f"{d}/collection/log.csv", "endpoint,entry-date,status,exception,resource\ne1,2021-01-01T10:00:00Z,200,,r1\n")
    _write(f"{d}/var/cache/organisation.csv", "organisation,name,dataset\nlocal-authority:A,Alpha,ds\n")


def test_cli_reports_use_the_clock(spark, scratch):
    from datetime import datetime, timezone

    d = scratch
    _registry(d)
    common = ["--collection-dir", f"{d}/collection", "--specification-dir", f"{d}/specification", "--cache-dir", f"{d}/var/cache"]
    before = datetime.now(timezone.utc)
    assert main(["build-reports", *common, "--out", f"{d}/now"]) == 0
    assert main(["build-reports", *common, "--out", f"{d}/then", "--as-of", "2021-01-05"]) == 0
    def days(x):
        return spark.read.parquet(f"{x}/reporting_latest_endpoints.parquet").where("endpoint = 'e1'").first()["days_since_200"]
    assert days(f"{d}/then") == 3
    assert days(f"{d}/now") - (before - datetime(2021, 1, 1, 10, tzinfo=timezone.utc)).days in (0, 1)


def test_cli_consolidate_all_manifest_and_database(spark, scratch):
    d = scratch
    _registry(d)
    _write(f"{d}/specification/schema-field.csv", "schema,field\nendpoint,endpoint\nendpoint,endpoint-url\nlookup,prefix\nlookup,entity\n")
    _write(f"{d}/var/pipeline/tree/lookup.csv", "prefix,entity\np,1\n")
    _write(f"{d}/var/pipeline/area/lookup.csv", "entity,prefix\n2,q\n")
    assert main(["consolidate-all", "pipeline", "--var-dir", f"{d}/var/pipeline", "--out-dir", f"{d}/pipeline",
                 "--schema-field", f"{d}/specification/schema-field.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/pipeline/lookup.csv"), "prefix", "entity") == [("p", "1"), ("q", "2")]
    assert rows(spark.read.parquet(f"{d}/pipeline/lookup.parquet"), "prefix", "entity") == [("p", "1"), ("q", "2")]
    assert main(["manifest", "issue", "--input-dir", f"{d}/collection", "--output", f"{d}/m.csv", "--as-of", "2021-01-05"]) == 0
    assert rows(read_csv_text(spark, f"{d}/m.csv"), "output_path") == [("var/issue/tree/r1.csv",)]
    assert main(["manifest", "issue", "--input-dir", f"{d}/collection", "--output", f"{d}/p.csv", "--landed", f"{d}/m.csv"]) == 0
    assert read_csv_text(spark, f"{d}/p.csv").count() == 0
    assert main(["manifest", "pipeline-files", "--input-dir", f"{d}/collection", "--output", f"{d}/f.csv"]) == 0
    assert read_csv_text(spark, f"{d}/f.csv").count() == 12
    assert main(["load-registry", "--collection-dir", f"{d}/collection", "--specification-dir", f"{d}/specification",
                 "--pipeline-dir", f"{d}/pipeline", "--cache-dir", f"{d}/var/cache"]) == 0
    assert rows(spark.table("source_pipeline")) == [("s1", "tree"), ("s2", "area"), ("s2", "tree")]
    assert spark.table("lookup").count() == 2 and spark.table("resource_dataset").count() == 1


def test_cli_manifests_by_dataset(spark, scratch):
    d = scratch
    _write(f"{d}/specification/dataset.csv", "dataset,collection\ntree,c1\nhedge,\n")
    found = {}
    for kind in ("expectation", "expectation-csv", "operational-issue"):
        assert main(["manifest", kind, "--spec-dir", f"{d}/specification", "--output", f"{d}/{kind}.csv", "--as-of", "2003-01-01T00:00:00Z"]) == 0
        found[kind] = sorted(r["output_path"] for r in read_csv_text(spark, f"{d}/{kind}.csv").collect())
    assert found == {"expectation": ["var/expectations/tree.parquet"],
                     "expectation-csv": ["var/expectations/tree-expectation-issue.csv", "var/expectations/tree-expectation-result.csv"],
                     "operational-issue": ["performance/operational_issue/hedge/operational-issue.csv", "performance/operational_issue/tree/operational-issue.csv"]}


def test_cli_expectation_results(spark, scratch):
    d = scratch
    _write(f"{d}/specification/dataset.csv", "dataset,collection\ntree,c1\n")
    _write(f"{d}/cache/tree-expectation-result.csv", "name,passed\nx,true\n")
    _write(f"{d}/cache/area-expectation-result.csv", "passed,name,extra\nfalse,y,1\n")
    assert main(["expectations", "--spec-dir", f"{d}/specification", "--cache-dir", f"{d}/cache", "--output-dir", f"{d}/out", "--as-of", "2003-01-01T00:00:00Z"]) == 0
    assert rows(read_csv_text(spark, f"{d}/out/expectation-result.csv"), "name", "passed", "extra") == [("x", "true", ""), ("y", "false", "1")]
    assert not os.path.exists(f"{d}/out/expectation-issue.csv") and [len(rows(read_csv_text(spark, f"{d}/out/{m}.csv"))) for m in ("manifest", "manifest-csv")] == [1, 2]


def test_cli_quarantine(spark, scratch):
    d = scratch
    _write(f"{d}/schema-field.csv", "schema,field\nlog,endpoint\nlog,entry-date\n")
    _write(f"{d}/in/log.csv", "endpoint,entry-date\ne1,2021-01-01\ne2,soon\ne3,2021-01-02,more\n")
    assert main(["consolidate", "log", f"{d}/out/log.csv", f"{d}/in/log.csv", "--schema-field", f"{d}/schema-field.csv", "--quarantine", f"{d}/bad"]) == 0
    assert rows(read_csv_text(spark, f"{d}/out/log.csv")) == [("e1", "2021-01-01T00:00:00Z")]
    assert rows(read_csv_text(spark, f"{d}/bad/dates.csv"), "endpoint", "bad_columns") == [("e2", "entry-date")]
    assert rows(read_csv_text(spark, f"{d}/bad/surplus.csv"), "row", "cells") == [("3", '["e3","2021-01-02","more"]')]


def test_cli_groups_and_landed_files(spark, scratch):
    d = scratch
    _write(f"{d}/list.csv", "slug,name\n/a,A\n/b,B\n,\n/c,C\n")
    assert main(["groups", f"{d}/list.csv", f"{d}/groups.csv"]) == 0
    assert rows(read_csv_text(spark, f"{d}/groups.csv"), "slug", "group_id") == [("/a", "0"), ("/b", "0"), ("/c", "1")]
    from regscope.plans.build import COLUMN_FIELD_FIELDS

    head = ",".join(COLUMN_FIELD_FIELDS)
    blank = "," * (len(COLUMN_FIELD_FIELDS) - 4)
    run = ["append-landed", "column-field", "--input-dir", f"{d}/var/column-field", "--output", f"{d}/column-field.parquet"]
    for name in ("aa", "bb"):
        _write(f"{d}/var/column-field/tree/{name}.csv", f"{head}\nx,y,WKT,geometry{blank}\n")
        assert main(run) == 0
    assert rows(spark.read.parquet(f"{d}/column-field.parquet"), "dataset", "resource", "field") == [("tree", "aa", "geometry"), ("tree", "bb", "geometry")]


def test_cli_duplicate_issues_follow_file_order(spark, scratch):
    d = scratch
    body = "".join(f"{i % 40},geometry,{i}\n" for i in range(200))
    _write(f"{d}/var/issue/tree/aa.csv", "row-number,field,line-number\n" + body)
    _write(f"{d}/var/issue/area/bb.csv", "field,row-number,line-number\ngeometry,1,7\n")
    assert main(["duplicate-issues", "--input-dir", f"{d}/var/issue", "--output", f"{d}/dup.csv"]) == 0
    assert sorted(int(r["line-number"]) for r in read_csv_text(spark, f"{d}/dup.csv").collect()) == list(range(40, 200))

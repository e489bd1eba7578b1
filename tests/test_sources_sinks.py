import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from regscope import sinks
from regscope.plans import build
from regscope.sources import csv as C
from regscope.sources import parquet as P
from regscope.sources.parquet import read_parquet_union
from regscope.sources.registry import register_tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_read_csv_text_blanks_and_multiline(spark, scratch):
    _write(f"{scratch}/a.csv", 'x,y,z\n1,"two\nlines",\n"",3,"q"\n4\n')
    df = C.read_csv_text(spark, f"{scratch}/a.csv")
    assert rows(df) == sorted([("1", "two\nlines", ""), ("", "3", "q"), ("4", "", "")])


def test_read_csv_union_matches_by_name(spark, scratch):
    _write(f"{scratch}/c1/source.csv", "source,endpoint\ns1,e1\n")
    _write(f"{scratch}/c2/source.csv", "endpoint,source,licence\ne2,s2,ogl\n")
    _write(f"{scratch}/c3/source.csv", "")  # zero-byte file: no rows
    df = C.read_collection_table(spark, scratch, "source")
    assert rows(df, "source", "endpoint", "licence") == [("s1", "e1", ""), ("s2", "e2", "ogl")]


def test_read_partitioned_csv_path_keys(spark, scratch):
    _write(f"{scratch}/issue/tree/abc123.csv", "resource,pipeline,field\nzzz,other,geometry\n")
    _write(f"{scratch}/issue/area/ff00.csv", "field\nname\n")
    df = C.read_partitioned_csv(spark, f"{scratch}/issue", "pipeline")
    assert rows(df, "pipeline", "resource", "field") == [("area", "ff00", "name"), ("tree", "abc123", "geometry")]


def test_read_partitioned_csv_bad_path_aborts(spark, scratch):
    _write(f"{scratch}/issue/tree/NOT-HEX.csv", "field\nname\n")
    with pytest.raises(Exception, match="path does not name"):
        C.read_partitioned_csv(spark, f"{scratch}/issue", "pipeline").collect()


def test_read_csv_typed(spark, scratch):
    _write(f"{scratch}/oi.csv", "dataset,line-number\ntree,3\n")
    df = C.snake_case_columns(C.read_csv_typed(spark, f"{scratch}/oi.csv"))
    assert df.columns == ["dataset", "line_number"]
    assert dict(df.dtypes)["line_number"] == "int"


def test_parquet_union_widens_int_bigint(spark, scratch):
    spark.createDataFrame([(1, "a")], "n int, s string").write.parquet(f"{scratch}/p/one.parquet")
    spark.createDataFrame([(2, 0.5)], "n bigint, score double").write.parquet(f"{scratch}/p/two.parquet")
    df = read_parquet_union(spark, [f"{scratch}/p/one.parquet", f"{scratch}/p/two.parquet"])
    assert dict(df.dtypes)["n"] == "bigint"
    assert rows(df, "n", "s", "score") == [(1, "a", None), (2, None, 0.5)]


def test_register_tables(spark, scratch):
    _write(f"{scratch}/col/c1/issue-type.csv", "issue-type,severity\nmissing,error\n")
    out = register_tables(spark, {"issue-type": f"{scratch}/col", "nothing": f"{scratch}/none"})
    assert list(out) == ["issue_type"]
    assert spark.sql("SELECT issue_type, severity FROM issue_type").collect()[0][0] == "missing"


def test_sinks_round_trip(spark, scratch):
    df = spark.createDataFrame([("a", "1")], "x string, y string")
    p = sinks.write_parquet(df, "t", scratch)
    assert rows(spark.read.parquet(p)) == [("a", "1")]
    c = sinks.write_csv(df, ["y", "x", "z"], f"{scratch}/t.csv")
    back = C.read_csv_text(spark, c)
    assert back.columns == ["y", "x", "z"] and rows(back) == [("1", "a", "")]
    with pytest.raises(ValueError, match="undeclared"):
        sinks.write_strict(df, ["x"], f"{scratch}/strict.csv")
    m = sinks.materialize(df.withColumn("k", F.lit(1)), "probe")
    assert rows(m) == [("a", "1", 1)]
    assert "regscope/probe-" in m.inputFiles()[0]


def test_consolidate_collection_job(spark, scratch):
    _write(f"{scratch}/var/c1/source.csv",
           "source,collection,organisation,endpoint,pipeline,entry-date,start-date,extra\n"
           "s1,c1,o1,e1,tree,2020-01-02T03:04:05.6+01:00,2020-01,x\n,c1,o1,e2,area,2021,,y\n")
    fields = {"source": ["source", "collection", "organisation", "endpoint", "dataset", "entry-date", "start-date",
                         "end-date"]}
    out = build.consolidate_collection(spark, f"{scratch}/var", f"{scratch}/out", fields, tables=["source"])
    df = C.read_csv_text(spark, out["source"])
    import hashlib
    assert df.columns == fields["source"]
    assert rows(df) == sorted([
        (hashlib.md5(b"c1|o1|e1").hexdigest(), "c1", "o1", "e1", "tree", "2020-01-02T03:04:05Z", "2020-01-01", ""),
        ("", "c1", "o1", "e2", "area", "2021-01-01T00:00:00Z", "", ""),
    ])


def test_concat_converted_resources_mismatch(spark, scratch):
    _write(f"{scratch}/conv/tree/abc.csv", "dataset,resource,elapsed,status,exception\ntree,abc,1.5,done,\n"
                                           "area,abd,2,done,\n")
    table, mism = build.concat_converted_resources(spark, f"{scratch}/conv", f"{scratch}/out")
    assert len(C.read_csv_text(spark, table).collect()) == 2
    assert rows(mism, "field", "dir_value", "file_value") == [("dataset", "tree", "area"), ("resource", "abc", "abd")]


def test_concat_issues_strict_and_path_keys(spark, scratch):
    from regscope.plans.build import ISSUE_FIELDS
    _write(f"{scratch}/var/issue/tree/abc.csv", "row-number,field,issue-type\n1,geometry,missing\n")
    out = build.concat_issues(spark, f"{scratch}/var/issue", f"{scratch}/issues")
    df = C.read_csv_text(spark, out)
    assert df.columns == ISSUE_FIELDS
    assert rows(df, "resource", "pipeline", "row-number", "entity") == [("abc", "tree", "1", "")]
    _write(f"{scratch}/var/issue2/tree/abd.csv", "row-number,surprise\n1,x\n")
    with pytest.raises(ValueError, match="undeclared"):
        build.concat_issues(spark, f"{scratch}/var/issue2", f"{scratch}/issues2")


def test_build_performance_tables_match_queries(spark, scratch):
    from regscope.fixtures import Fixtures
    from regscope.operators.quality import check_columns
    from regscope.plans.performance import EXPECTED_COLUMNS
    from regscope.queries import AS_OF, QUERIES
    sf = "/root/testdata/sf0.001"
    out = build.build_performance_tables(Fixtures.of(spark, sf).registry_tables(), scratch, AS_OF)
    written = {k: spark.read.parquet(v) for k, v in out.items()}
    assert rows(written["provision_summary"]) == rows(QUERIES["provision_summary"](spark, sf))
    assert rows(written["endpoint_dataset_summary"]) == rows(QUERIES["endpoint_summary"](spark, sf))
    expected = {k: v for k, v in EXPECTED_COLUMNS.items() if k in written}
    assert check_columns(spark, written, expected).count() == 4
    with pytest.raises(ValueError, match="lacks dataset"):
        check_columns(spark, {"provision_summary": written["provision_summary"].drop("dataset")},
                      {"provision_summary": EXPECTED_COLUMNS["provision_summary"]})


def test_sorted_sink(spark, scratch):
    df = spark.createDataFrame([(i % 7, f"v{i}") for i in range(50)], "k int, v string").repartition(4)
    p = sinks.write_parquet(df, "s", scratch, sort_by=["k desc", "v"])
    back = [(r["k"], r["v"]) for r in spark.read.parquet(p).collect()]
    assert back == sorted(back, key=lambda x: (-x[0], x[1]))


def test_consolidate_files_and_catalogue_from_collection(spark, scratch):
    _write(f"{scratch}/a.csv", "endpoint,entry-date\ne1,2020\n")
    _write(f"{scratch}/b.csv", "entry-date,endpoint,end-date\n2021-02,e2,2022-03-04\n")
    out = build.consolidate_files(spark, "endpoint", ["endpoint", "entry-date", "end-date"],
                                  [f"{scratch}/a.csv", f"{scratch}/b.csv"], f"{scratch}/endpoint-out.csv")
    assert rows(C.read_csv_text(spark, out)) == [("e1", "2020-01-01T00:00:00Z", ""),
                                                 ("e2", "2021-02-01T00:00:00Z", "2022-03-04")]
    col = f"{scratch}/collection"
    _write(f"{col}/endpoint.csv", "endpoint,endpoint-url\ne1,u\ne2,u2\ne1,u\n")
    _write(f"{col}/source.csv", "source,collection,endpoint,pipelines\ns1,c1,e1,tree\ns2,c2,e1,area\ns3,c3,,x\n")
    _write(f"{col}/resource.csv", "resource,endpoints\nr1,e1\nr2,e2;e1\nr3,e9\nr4,e1\n")
    _write(f"{col}/old-resource.csv", "old-resource,resource\nr4,r5\n")
    cat = build.catalogue_from_collection(spark, col)
    # e1: last source row names c2, pipelines tree+area; e2: no source -> '' collection, no pipelines
    assert rows(cat) == [("c2", "area", "r1"), ("c2", "area", "r2"), ("c2", "tree", "r1"), ("c2", "tree", "r2")]


def test_read_csv_union_uniform_fast_path(spark, scratch):
    _write(f"{scratch}/u/c1/log.csv", "endpoint,status\ne1,200\n")
    _write(f"{scratch}/u/c2/log.csv", "endpoint,status\ne2,\n")
    df = C.read_csv_union(spark, f"{scratch}/u/*/log.csv", uniform=True)
    assert rows(df) == [("e1", "200"), ("e2", "")]
    assert C.read_csv_union(spark, f"{scratch}/nothing/*.csv", uniform=True) is None


def test_parquet_union_fast_path_merges_by_name(spark, scratch):
    spark.createDataFrame([(1, "a")], "n bigint, s string").write.parquet(f"{scratch}/q/one.parquet")
    spark.createDataFrame([(2, 0.5)], "n bigint, score double").write.parquet(f"{scratch}/q/two.parquet")
    df = read_parquet_union(spark, [f"{scratch}/q/one.parquet", f"{scratch}/q/two.parquet"])
    assert rows(df, "n", "s", "score") == [(1, "a", None), (2, None, 0.5)]


def test_registry_locations_and_links(spark, scratch):
    from regscope.sources.registry import register_link_tables, registry_locations
    loc = registry_locations(f"{scratch}/collection", f"{scratch}/specification", f"{scratch}/pipeline",
                             f"{scratch}/cache")
    assert loc["log"].endswith("/collection") and loc["issue-type"].endswith("/specification")
    assert loc["default-value"].endswith("/pipeline") and loc["organisation"].endswith("/cache")
    assert len(loc) == 49 and loc["converted-resource"] == "converted-resource/"
    _write(f"{scratch}/collection/source.csv", "source,organisation,endpoint,pipelines\ns1,o1,e1,tree;area\n")
    _write(f"{scratch}/collection/resource.csv", "resource,endpoints\nr1,e1;e2\n")
    tables = register_tables(spark, {"source": f"{scratch}/collection", "resource": f"{scratch}/collection"})
    tables["specification"] = spark.createDataFrame([("brownfield", "tree;area")], "specification string, datasets string")
    links = register_link_tables(tables)
    assert sorted(links) == ["resource_dataset", "resource_endpoint", "resource_organisation", "source_pipeline", "specification_dataset"]
    assert links["specification_dataset"].count() == 2
    got = spark.sql("SELECT resource, dataset FROM resource_dataset ORDER BY dataset").collect()
    assert [tuple(r) for r in got] == [("r1", "area"), ("r1", "tree")]


def test_read_blank_delimited_groups(spark, scratch):
    _write(f"{scratch}/groups.csv", "slug,name,geography,url\n/a/1,A one,g:1,u1\n/a/2,A two,g:2,u2\n,,,\n"
                                    "/b/1,B,g:3,u3\n,,,\n,,,\n/c/1,\"C, with comma\",g:4,u4\n/c/2,C2,g:5,u5\n")
    df = C.read_blank_delimited_groups(spark, f"{scratch}/groups.csv")
    got = sorted((r["slug"], r["group_id"]) for r in df.collect())
    assert got == [("/a/1", 0), ("/a/2", 0), ("/b/1", 1), ("/c/1", 3), ("/c/2", 3)]


def test_consolidate_quarantine(spark):
    from regscope.plans.consolidate import consolidate_quarantine
    df = spark.createDataFrame([("e1", "2020-01-02T03:04:05Z", "2020"), ("e2", "2020-01-02T03:04:05", "2020-01"),
                                ("e3", "", "13/01/2020")], "endpoint string, `entry-date` string, `start-date` string")
    good, bad = consolidate_quarantine(df, "endpoint", ["endpoint", "entry-date", "start-date"])
    assert rows(good) == [("e1", "2020-01-02T03:04:05Z", "2020-01-01")]
    assert rows(bad, "endpoint", "bad_columns") == [("e2", "entry-date"), ("e3", "start-date")]


def test_managed_table_sinks(spark, scratch):
    name = f"probe_{os.path.basename(scratch).replace('-', '_')}"
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([(2, "y")], "v int, k string")
    sinks.save_append(a, name)
    sinks.save_append(b, name)
    assert rows(spark.table(name), "k", "v") == [("x", 1), ("y", 2)]
    sinks.save_replace(a, name)
    assert rows(spark.table(name), "k", "v") == [("x", 1)]
    spark.sql(f"DROP TABLE {name}")


def test_csv_union_crlf_and_quoted_headers(spark, scratch):
    _write(f"{scratch}/q/c1/t.csv", '"a,b",c\r\n"1,2",x\r\n')
    _write(f"{scratch}/q/c2/t.csv", 'c,"a,b"\n"y\nz","3"\n')
    df = C.read_collection_table(spark, f"{scratch}/q", "t")
    assert sorted(df.columns) == ["a,b", "c"]
    assert rows(df, "a,b", "c") == [("1,2", "x"), ("3", "y\nz")]


def test_sniff_files(spark, scratch):
    samples = {"a.csv": b"x,y\n1,2\n", "b.html": b"<!DOCTYPE html><p>", "c.json": b'{"type": 1}',
               "d.zip": b"PK\x03\x04....", "e.xls": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1....",
               "f.gpkg": b"SQLite format 3\x00....", "g.xml": b"<?xml version='1.0'?><a/>"}
    os.makedirs(f"{scratch}/landed", exist_ok=True)
    for name, data in samples.items():
        with open(f"{scratch}/landed/{name}", "wb") as f:
            f.write(data)
    got = {os.path.basename(r["path"]): r["filetype"] for r in C.sniff_files(spark, f"{scratch}/landed/*").collect()}
    assert got == {"a.csv": "csv", "b.html": "html", "c.json": "json", "d.zip": "zip", "e.xls": "excel",
                   "f.gpkg": "sqlite", "g.xml": "xml"}


def test_consolidate_checks_undeclared_date_columns(spark):
    from regscope.plans.consolidate import consolidate
    df = spark.createDataFrame([("e1", "2020-01-01", "2021"), ("e2", "2020-02-02", "garbage")],
                               "endpoint string, `start-date` string, `foo-date` string")
    with pytest.raises(Exception, match="not a date"):
        consolidate(df, "endpoint", ["endpoint", "start-date"]).collect()
    ok = consolidate(df.where("endpoint = 'e1'"), "endpoint", ["endpoint", "start-date"])
    assert rows(ok) == [("e1", "2020-01-01")]


def test_concat_operational_issues_and_single_file_tables(spark, scratch):
    from regscope.plans.build import OPERATIONAL_ISSUE_FIELDS
    from regscope.sources.registry import load_table
    _write(f"{scratch}/oi/tree/operational-issue.csv", "dataset,resource,line-number,issue-type\ntree,r1,1,missing\n")
    _write(f"{scratch}/oi/area/operational-issue.csv", "issue-type,dataset,resource\ninvalid,area,r2\n")
    out = build.concat_operational_issues(spark, f"{scratch}/oi", f"{scratch}/oi-out")
    df = C.read_csv_text(spark, out)
    assert df.columns == OPERATIONAL_ISSUE_FIELDS
    assert rows(df, "dataset", "resource", "line-number", "issue-type") == [("area", "r2", "", "invalid"),
                                                                          ("tree", "r1", "1", "missing")]
    _write(f"{scratch}/spec/issue-type.csv", "issue-type,severity\nmissing,error\n")
    t = load_table(spark, f"{scratch}/spec", "issue-type")
    assert rows(t) == [("missing", "error")]


def test_csv_keeps_blanks_at_the_ends_of_cells(spark, scratch):
    df = spark.createDataFrame([("  lead", "trail  ", " "), ("\ttab", "a,b", 'q"q')], "a string, b string, c string")
    path = sinks.write_csv(df, ["a", "b", "c"], f"{scratch}/blanks.csv")
    assert rows(C.read_csv_text(spark, path)) == rows(df)


def test_surplus_cells_are_an_error_or_are_set_aside(spark, scratch):
    _write(f"{scratch}/s.csv", 'a,b\n1,2\n1,2,3\nx\n"q,q",y\n1,2,,4\n')
    with pytest.raises(Exception, match="wider than its header"):
        C.read_csv_text(spark, f"{scratch}/s.csv").collect()
    with pytest.raises(Exception, match="wider than its header"):
        C.read_csv_text(spark, f"{scratch}/s.csv").select("a").count()
    assert rows(C.read_csv_text(spark, f"{scratch}/s.csv", surplus="quarantine")) == [("1", "2"), ("q,q", "y"), ("x", "")]
    for block in (None, 4):
        assert rows(C.surplus_cells(spark, f"{scratch}/s.csv", block), "row", "cells") == [(2, '["1","2","3"]'), (5, '["1","2","","4"]')]
    with pytest.raises(Exception, match="wider than its header"):
        C.read_csv_union(spark, f"{scratch}/s.csv").collect()
    assert rows(C.read_csv_union(spark, f"{scratch}/s.csv", surplus="quarantine")) == [("1", "2"), ("q,q", "y"), ("x", "")]


def test_undeclared_columns_are_an_error_in_every_concatenation(spark, scratch):
    _write(f"{scratch}/cf/tree/aa.csv", "column,field,extra\nWKT,geometry,x\n")
    _write(f"{scratch}/cr/tree/aa.csv", "dataset,resource,elapsed,extra\ntree,aa,1,x\n")
    for run, folder in ((build.concat_column_fields, "cf"), (build.concat_converted_resources, "cr")):
        with pytest.raises(ValueError, match="undeclared"):
            run(spark, f"{scratch}/{folder}", f"{scratch}/out")


def test_union_by_name_over_many_files_and_wide_rows(spark, scratch):
    for i in range(60):
        _write(f"{scratch}/many/c{i}/t.csv", ("a,b\n" if i % 2 else "b,a\n") + f"{i},{i + 100}\n")
    _write(f"{scratch}/many/wide/t.csv", ",".join(f"w{i}" for i in range(40)) + "\n" + ",".join(str(i) for i in range(40)) + "\n")
    df = C.read_collection_table(spark, f"{scratch}/many", "t")
    assert df.count() == 61 and len(df.columns) == 42
    assert {(r["a"], r["b"]) for r in df.where("w0 = ''").collect()} == {(str(i), str(i + 100)) if i % 2 else (str(i + 100), str(i)) for i in range(60)}


def test_last_row_wins_over_part_files(spark, scratch):
    base = f"{scratch}/collection"
    _write(f"{base}/endpoint.csv/part-0.csv", "endpoint,collection\ne1,own1\ne2,own2\n")
    _write(f"{base}/endpoint.csv/part-1.csv", "endpoint,collection\ne2,own3\n")
    _write(f"{base}/source.csv/part-0.csv", "endpoint,collection,pipelines\ne1,c1,p1\n" + "e1,c1,p1\n" * 30)
    _write(f"{base}/source.csv/part-1.csv", "endpoint,collection,pipelines\ne1,c2,p2\n")
    _write(f"{base}/resource.csv", "resource,endpoints\nr1,e1\nr2,e2\n")
    assert rows(build.catalogue_from_collection(spark, base)) == [("c2", "p1", "r1"), ("c2", "p2", "r1")]
    from regscope.plans.catalogue import endpoint_index
    from regscope.sources.csv import read_positioned_csv
    collections, _ = endpoint_index(read_positioned_csv(spark, f"{base}/endpoint.csv"), read_positioned_csv(spark, f"{base}/source.csv"))
    assert rows(collections) == [("e1", "c2"), ("e2", "own3")]


def test_parquet_union_of_a_folder_with_drifting_types(spark, scratch):
    from datetime import date
    spark.createDataFrame([(1, date(2020, 1, 2))], "n int, at date").write.parquet(f"{scratch}/f/a")
    spark.sql("SELECT 2L n, TIMESTAMP_NTZ'2020-01-03 04:05:06' at").write.parquet(f"{scratch}/f/b")
    for paths in (f"{scratch}/f", f"{scratch}/f/*", [f"{scratch}/f/a", f"{scratch}/f/b"]):
        df = P.read_parquet_union(spark, paths)
        assert dict(df.dtypes) == {"n": "bigint", "at": "timestamp_ntz"} and df.count() == 2

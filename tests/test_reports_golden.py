"""A hand-built mini registry whose expected report rows are worked out by hand.

It carries what the fixture views do not: ``-eng`` and plain rows of one
organisation, a blank source id, blank pipelines, a NULL endpoint end date,
status ``200.0``, same-day ties, several cohorts of one provision and a NULL
provision end date.
"""

import pytest

from conftest import rows
from regscope.functions.keys import explode_list
from regscope.plans import catalogue as cat
from regscope.plans import performance as perf
from regscope.plans import registry as reg

AS_OF = "2022-01-01T00:00:00Z"


@pytest.fixture(scope="module")
def t(spark):
    S = "string"
    mk = lambda data, cols: spark.createDataFrame(data, ", ".join(f"{c} {S}" for c in cols))

    def positioned(data, cols):  # file order as an explicit position column
        return spark.createDataFrame([(*r, i) for i, r in enumerate(data)],
                                     ", ".join(f"{c} {S}" for c in cols) + ", pos int")
    source = positioned([("s1", "local-authority-eng:A", "c1", "e1", "ogl", "doc1", "tree;area"),
                 ("s2", "local-authority:A", "c1", "e2", "", "doc2", "tree"),
                 ("s3", "local-authority-eng:B", "c2", "e3", "", "doc3", ""),
                 ("", "local-authority-eng:B", "c2", "e4", "", "doc4", "tree")],
                ["source", "organisation", "collection", "endpoint", "licence", "documentation_url", "pipelines"])
    tables = {
        "organisation": mk([("local-authority:A", "Alpha", "ds-a"), ("local-authority:B", "Beta", "ds-b")],
                           ["organisation", "name", "dataset"]),
        "source": source,
        "source_pipeline": explode_list(source, "pipelines", "pipeline", keep=["source"]),
        "endpoint": mk([("e1", "u1", "2020-01-01T00:00:00Z", ""), ("e2", "u2", "2020-02-01T00:00:00Z", ""),
                        ("e3", "u3", "2020-03-01T00:00:00Z", "2021-01-01"),
                        ("e4", "u4", "2020-01-15T00:00:00Z", None)],
                       ["endpoint", "endpoint_url", "entry_date", "end_date"]),
        "log": mk([("e1", "2021-01-01T10:00:00Z", "200", "", "r1"), ("e1", "2021-01-01T12:00:00Z", "200", "", "r2"),
                   ("e1", "2020-12-31T12:00:00Z", "404", "", ""), ("e2", "2021-02-01T00:00:00Z", "200.0", "", "r1"),
                   ("e2", "2021-01-15T00:00:00Z", "", "ConnectionError", ""),
                   ("e3", "2021-03-01T00:00:00Z", "200", "", "r3"), ("e4", "2021-01-20T00:00:00Z", "200", "", "r1")],
                  ["endpoint", "entry_date", "status", "exception", "resource"]),
        "resource": positioned([("r1", "2020-01-01", "", "e1;e2"), ("r2", "2020-06-01", "", "e1"),
                        ("r3", "2020-03-01", "2021-06-01", "e3")],
                       ["resource", "start_date", "end_date", "endpoints"]),
        "provision": mk([("local-authority:A", "tree", "c1", "statutory", ""),
                         ("local-authority:A", "tree", "c2", "statutory", ""),
                         ("local-authority:B", "tree", "c1", "expected", None)],
                        ["organisation", "dataset", "cohort", "provision_reason", "end_date"]),
        "issue": spark.createDataFrame(
            [("r1", "tree", "1", "geometry", "missing", "v", 1), ("r1", "tree", "2", "geometry", "missing", "v", 2),
             ("r2", "tree", "1", "name", "invalid", "v", 3), ("r3", "tree", "1", "name", "invalid", "v", 4)],
            "resource string, dataset string, row_number string, field string, issue_type string, value string, "
            "line_number long"),
        "issue_type": mk([("missing", "error", "external"), ("invalid", "warning", "internal")],
                         ["issue_type", "severity", "responsibility"]),
        "column_field": mk([("r1", "tree", "Start_Date", "start-date"), ("r1", "tree", "WKT", "geometry"),
                            ("r1", "tree", "ref no", "reference"), ("r1", "tree", "x,y", "a,b"),
                            ("r3", "tree", "A", "a")], ["resource", "dataset", "column", "field"]),
        "old_resource": mk([("r2", "r9")], ["old_resource", "resource"]),
    }
    return tables


def test_most_recent_log(t):
    out = rows(reg.most_recent_log(t["log"]), "endpoint", "entry_date")
    assert out == [("e1", "2021-01-01T10:00:00Z"), ("e1", "2021-01-01T12:00:00Z"), ("e2", "2021-02-01T00:00:00Z"),
                   ("e3", "2021-03-01T00:00:00Z"), ("e4", "2021-01-20T00:00:00Z")]


def test_historic_reporting(t):
    h = reg.historic_endpoints(t, "reporting")
    assert h.columns == perf.EXPECTED_COLUMNS["reporting_historic_endpoints"]
    got = rows(h, "organisation", "pipeline", "endpoint", "latest_status", "resource", "latest_log_entry_date")
    assert got == [
        ("local-authority-eng:A", "area", "e1", "200", "r1", "2021-01-01"),
        ("local-authority-eng:A", "area", "e1", "200", "r2", "2021-01-01"),
        ("local-authority-eng:A", "area", "e1", "404", "", "2020-12-31"),
        ("local-authority-eng:A", "tree", "e1", "200", "r1", "2021-01-01"),
        ("local-authority-eng:A", "tree", "e1", "200", "r2", "2021-01-01"),
        ("local-authority-eng:A", "tree", "e1", "404", "", "2020-12-31"),
        ("local-authority-eng:B", "", "e3", "200", "r3", "2021-03-01"),   # blank pipelines list
        ("local-authority-eng:B", "tree", "e4", "200", "r1", "2021-01-20"),  # blank source id
        ("local-authority:A", "tree", "e2", "", "", "2021-01-15"),
        ("local-authority:A", "tree", "e2", "200.0", "r1", "2021-02-01"),
    ]


def test_historic_registry_uses_organisation_dataset(t):
    h = reg.historic_endpoints(t, "registry")
    assert {r["dataset"] for r in h.collect()} == {"ds-a", "ds-b"}
    assert {r["latest_log_entry_date"] for r in h.where("endpoint = 'e2'").collect()} == {
        "2021-02-01T00:00:00Z", "2021-01-15T00:00:00Z"}


def test_latest_reporting(t):
    latest = reg.latest_endpoints(t, "reporting", as_of=AS_OF)
    assert latest.columns == perf.EXPECTED_COLUMNS["reporting_latest_endpoints"]
    got = rows(latest, "organisation", "pipeline", "endpoint", "latest_status", "resource", "days_since_200", "rn")
    # e3 ended, e4's NULL end date fails end_date = ''; 200.0 is not a success
    assert got == [("local-authority-eng:A", "area", "e1", "200", "r2", 364, 1),
                   ("local-authority-eng:A", "tree", "e1", "200", "r2", 364, 1),
                   ("local-authority:A", "tree", "e2", "200.0", "r1", None, 1)]


def test_endpoint_summary_tie_on_cut_date(t):
    es = perf.endpoint_summary(reg.historic_endpoints(t, "reporting"))
    got = rows(es, "organisation", "dataset", "endpoint", "resource", "latest_status", "latest_log_entry_date")
    # r1 and r2 tie on the day; resource desc picks r2. e3 ended; e4 (NULL end) kept.
    assert got == [("local-authority-eng:A", "area", "e1", "r2", "200", "2021-01-01"),
                   ("local-authority-eng:A", "tree", "e1", "r2", "200", "2021-01-01"),
                   ("local-authority-eng:B", "tree", "e4", "r1", "200", "2021-01-20"),
                   ("local-authority:A", "tree", "e2", "r1", "200.0", "2021-02-01")]


def test_issue_counts(t):
    ic = perf.issue_counts(t["issue"], t["resource"], t["issue_type"], as_of=AS_OF)
    assert rows(ic, "dataset", "resource", "issue_type", "field", "count_issues", "severity", "date") == [
        ("tree", "r1", "missing", "geometry", 2, "error", "01-01-2022"),
        ("tree", "r2", "invalid", "name", 1, "warning", "01-01-2022")]


def test_column_field_summary(t):
    cf = perf.column_field_summary(t["column_field"], t["resource"])
    assert rows(cf) == [("r1", "tree", "geometry;start-date", "a;b;reference")]


def test_provision_summary(t):
    hist = reg.historic_endpoints(t, "reporting")
    prov = perf.provision_data(t["provision"], t["organisation"])
    pr = perf.provision_reporting(prov, perf.reporting_data(hist))
    ps = perf.provision_summary(pr, perf.issue_counts(t["issue"], t["resource"], t["issue_type"], AS_OF))
    assert ps.columns == perf.EXPECTED_COLUMNS["provision_summary"]
    # two cohorts double the issue sums; the NULL-end provision forms no group
    assert rows(ps) == [("local-authority:A", "Alpha", "tree", "statutory", "", 2, 1, 0, 4, 2, 0, 0, 0)]


def test_resource_catalogue_and_unmapped(t):
    c = cat.resource_catalogue(t["endpoint"], t["source"], t["resource"], t["old_resource"])
    # r2 is superseded (old_resource); r1 lists e1 (tree, area) and e2 (tree); collection of e2 (last listed)
    assert rows(c) == [("c1", "area", "r1"), ("c1", "tree", "r1"), ("c2", "", "r3")]
    u = cat.unmapped_resources(t["endpoint"], t["source"], t["resource"], t["old_resource"])
    assert rows(u) == [("r3", "c2", "blank-pipeline")]


def test_planning_authorities_and_indexes(t):
    assert rows(cat.planning_authorities(t["source"])) == [
        ("local-authority-eng:A",), ("local-authority-eng:B",), ("local-authority:A",)]
    assert rows(cat.organisation_datasets(t["source"])) == [
        ("local-authority-eng:A", "area;tree", 2), ("local-authority-eng:B", ";tree", 2),
        ("local-authority:A", "tree", 1)]


def test_unmapped_resource_reasons(spark):
    from regscope.plans.catalogue import unmapped_resources
    endpoint = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "endpoint string")
    source = spark.createDataFrame([("s1", "c1", "e1", "tree", 0), ("s3", "c3", "e3", "tree;", 1)],
                                   "source string, collection string, endpoint string, pipelines string, pos int")
    resource = spark.createDataFrame([("r1", "e1", 0), ("r2", "e9", 1), ("r3", "e2", 2), ("r4", "e3", 3)],
                                     "resource string, endpoints string, pos int")
    old = spark.createDataFrame([], "old_resource string, resource string")
    got = sorted(tuple(r) for r in unmapped_resources(endpoint, source, resource, old).collect())
    # r1 fine; r2 lists no known endpoint; r3's endpoint has no source; r4's source lists a blank pipeline
    assert got == [("r2", None, "no-endpoint"), ("r3", "", "no-pipeline"), ("r4", "c3", "blank-pipeline")]

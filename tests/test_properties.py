"""Operators against brute-force Python models on random small inputs."""

from datetime import date

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from regscope.functions.dates import normalise_date
from regscope.functions.keys import explode_list
from regscope.operators.aggregates import top_by
from regscope.operators.windows import blank_delimited_groups, repeated_rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
maybe = lambda s: st.one_of(st.none(), s)


def _key(v):
    # NULL sorts below every value (descending order puts it last)
    return (v is not None, v if v is not None else "")


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), maybe(st.sampled_from(["2020", "2021", "2020-06"])),
                          maybe(st.sampled_from(["x", "y"])), st.integers(0, 9)), min_size=1, max_size=25))
def test_top_by_is_greatest_tuple(spark, data):
    df = spark.createDataFrame(data, "k string, d string, t string, p int")
    got = rows(top_by(df, "k", order=["d", "t", "p"]), "k", "d", "t", "p")
    best = {}
    for r in data:
        cur = best.get(r[0])
        if cur is None or tuple(map(_key, r[1:])) > tuple(map(_key, cur[1:])):
            best[r[0]] = r
    assert got == sorted(best.values())


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["f1", "f2"]), st.sampled_from(["1", "2", "3"]),
                          st.sampled_from(["geometry", "name"])), max_size=30))
def test_repeated_rows_matches_seen_set(spark, data):
    rows_in = [(f, rn, fld, i) for i, (f, rn, fld) in enumerate(data)]
    df = spark.createDataFrame(rows_in, "file string, rn string, field string, pos int") if rows_in else \
        spark.createDataFrame([], "file string, rn string, field string, pos int")
    got = rows(repeated_rows(df, ["file"], ["rn", "field"], "pos"), "pos")
    seen, expect = set(), []
    for f, rn, fld, i in rows_in:
        if (f, rn, fld) in seen:
            expect.append((i,))
        seen.add((f, rn, fld))
    assert got == expect


@SETTINGS
@given(st.lists(st.booleans(), min_size=1, max_size=40), st.sampled_from([1, 2, 3, 7, 1 << 20]))
def test_blank_groups_match_running_count(spark, blanks, width):
    data = [(i + 1, "" if b else f"/s/{i}", "" if b else f"n{i}") for i, b in enumerate(blanks)]
    df = spark.createDataFrame(data, "pos long, slug string, name string")
    got = rows(blank_delimited_groups(df, "pos", ["slug", "name"], bucket_width=width), "pos", "group_id")
    n, expect = 0, []
    for pos, slug, _ in data:
        if slug == "":
            n += 1
        else:
            expect.append((pos, n))
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.dates(date(1900, 1, 1), date(2099, 12, 31)), st.sampled_from([10, 7, 4, 0])),
                min_size=1, max_size=20))
def test_normalise_date_matches_python(spark, data):
    texts = [d.isoformat()[:n] for d, n in data]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(normalise_date("v")).collect()]
    expect = []
    for t in texts:
        if not t:
            expect.append("")
        else:
            y, m, d = (t.split("-") + ["01", "01"])[:3]
            expect.append(f"{y}-{m}-{d}")
    assert got == expect


@SETTINGS
@given(st.lists(maybe(st.text(alphabet="ab;", max_size=6)), min_size=1, max_size=10))
def test_explode_list_matches_split(spark, lists):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v string")
    got = rows(explode_list(df, "v", "item", keep=["i"]), "i", "item")
    expect = sorted((i, x) for i, v in enumerate(lists) if v is not None for x in v.split(";"))
    assert got == expect


keys = st.sampled_from(["a", "b", None])


@SETTINGS
@given(st.lists(st.tuples(keys, keys, st.integers(0, 5)), min_size=1, max_size=12),
       st.lists(st.tuples(keys, keys, st.integers(10, 15)), max_size=12))
def test_null_safe_left_join_matches_pandas_merge(spark, left, right):
    import pandas as pd

    from regscope.operators.joins import null_safe_left_join
    lp = pd.DataFrame(left, columns=["organisation", "dataset", "x"])
    rp = pd.DataFrame(right, columns=["organisation", "pipeline", "y"])
    expect = lp.merge(rp, left_on=["organisation", "dataset"], right_on=["organisation", "pipeline"], how="left")
    ls = spark.createDataFrame(left, "organisation string, dataset string, x int")
    rs = spark.createDataFrame(right, "organisation string, pipeline string, y int")
    got = null_safe_left_join(ls, rs, [("organisation", "organisation"), ("dataset", "pipeline")])
    assert got.columns == list(expect.columns)

    def norm(v):
        return None if v is None or (isinstance(v, float) and v != v) else (int(v) if isinstance(v, float) else v)
    exp_rows = sorted((tuple(norm(v) for v in r) for r in expect.itertuples(index=False)), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exp_rows


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["o1", "o2"]), st.sampled_from(["c1", "c2"]),
                          maybe(st.sampled_from(["e1", "e2", "e3"])), maybe(st.sampled_from(["", "2020-01-01"])),
                          maybe(st.sampled_from(["200", "404"])), maybe(st.sampled_from(["r1", "r2"]))),
                min_size=1, max_size=10),
       st.lists(st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.sampled_from(["error", "warning", "notice"]),
                          st.sampled_from(["internal", "external"]), st.integers(1, 5)), max_size=10))
def test_provision_summary_matches_model(spark, prov_rows, issue_rows):
    from regscope.plans.performance import ISSUE_CLASSES, provision_summary
    cols = ["organisation", "cohort", "endpoint", "endpoint_end_date", "latest_status", "resource"]
    pr = spark.createDataFrame(prov_rows, ", ".join(f"{c} string" for c in cols)).selectExpr(
        "organisation", "'Name' AS organisation_name", "cohort", "'tree' AS dataset", "'statutory' AS provision_reason",
        "'' AS provision_end_date", "endpoint", "endpoint_end_date", "latest_status", "resource")
    issues = spark.createDataFrame([(r, "tree", s, p, n) for r, s, p, n in issue_rows],
                                   "resource string, dataset string, severity string, responsibility string, "
                                   "count_issues long")
    got = {r["organisation"]: tuple(r)[5:] for r in provision_summary(pr, issues).collect()}
    # model: merge rows = each provision row x its issue rows (or itself once); counts over the merge
    expect = {}
    for org in {p[0] for p in prov_rows}:
        merged = []
        for p in (p for p in prov_rows if p[0] == org):
            matches = [i for i in issue_rows if i[0] == p[5]]
            merged += [(p, i) for i in matches] or [(p, None)]
        active = [(p, i) for p, i in merged if p[3] in (None, "")]
        counts = [len({p[2] for p, _ in active if p[2] is not None}),
                  len({p[2] for p, _ in active if p[2] is not None and p[4] != "200"})]
        for s, r in ISSUE_CLASSES:
            counts.append(sum(i[3] for _, i in active if i and i[1] == s and i[2] == r))
        expect[org] = tuple(counts)
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.datetimes(min_value=__import__("datetime").datetime(1900, 1, 1),
                                       max_value=__import__("datetime").datetime(2099, 12, 31)),
                          st.sampled_from(["Z", ".5Z", ".123+01:00", "-05:30", "", "date", "month", "year"])),
                min_size=1, max_size=15))
def test_normalise_timestamp_matches_model(spark, data):
    from regscope.functions.dates import normalise_timestamp
    texts = []
    for dt, suffix in data:
        base = dt.strftime("%Y-%m-%dT%H:%M:%S")
        texts.append({"date": base[:10], "month": base[:7], "year": base[:4]}.get(suffix, base + suffix))
    texts = [t for t in texts if len(t) != 19]       # 19 characters (no zone marker) is an error shape
    if not texts:
        return
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(normalise_timestamp("v")).collect()]
    expect = []
    for t in texts:
        if len(t) >= 20:
            expect.append(t[:19] + "Z")
        else:
            y, m, d = (t.split("-") + ["01", "01"])[:3]
            expect.append(f"{y}-{m}-{d}T00:00:00Z")
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(maybe(st.sampled_from(["Start_Date", "start date", "WKT", "ref no", "Name", "x_y z"])),
                          maybe(st.sampled_from(["start-date", "geometry", "point", "name", "x-y-z", "ref-no"]))),
                min_size=1, max_size=20))
def test_mapping_fields_match_model(spark, data):
    from regscope.functions.keys import mapping_field, non_mapping_field
    df = spark.createDataFrame(data, "column string, field string")
    got = [tuple(r) for r in df.select(mapping_field(), non_mapping_field()).collect()]

    def model(column, field):
        special = field in ("geometry", "point") if field is not None else None
        same = None if column is None or field is None else \
            field.upper() == column.replace(" ", "-").replace("_", "-").upper()
        maps = True if (same is True or special is True) else None if (same is None or special is None) else False
        non = (None if same is None or special is None else (not same and not special))
        return (field if maps is True else None, field if non is True else None)
    assert got == [model(c, f) for c, f in data]


@SETTINGS
@given(st.lists(st.tuples(maybe(st.sampled_from(["", "s1", "s 2"])), maybe(st.text(alphabet="abc-:", max_size=5)),
                          maybe(st.text(alphabet="xyz|", max_size=4)), maybe(st.text(alphabet="0f", max_size=4))),
                min_size=1, max_size=15))
def test_source_key_matches_md5(spark, data):
    import hashlib

    from regscope.functions.keys import source_key
    df = spark.createDataFrame(data, "source string, collection string, organisation string, endpoint string")
    got = [r[0] for r in df.select(source_key()).collect()]
    expect = [hashlib.md5(f"{c or ''}|{o or ''}|{e or ''}".encode()).hexdigest() if s else s for s, c, o, e in data]
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.booleans(), st.integers(1, 5_000_000)), min_size=1, max_size=30),
       st.sampled_from([1, 1000, 1 << 20]))
def test_blank_groups_with_sparse_positions(spark, items, width):
    pos, data = 0, []
    for blank, gap in items:                       # strictly increasing, gappy positions
        pos += gap
        data.append((pos, "" if blank else f"/s/{pos}", "" if blank else "n"))
    df = spark.createDataFrame(data, "pos long, slug string, name string")
    got = rows(blank_delimited_groups(df, "pos", ["slug", "name"], bucket_width=width), "pos", "group_id")
    n, expect = 0, []
    for p, slug, _ in data:
        if slug == "":
            n += 1
        else:
            expect.append((p, n))
    assert got == expect

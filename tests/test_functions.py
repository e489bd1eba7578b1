import pytest
from pyspark.sql import functions as F

from regscope.functions import dates as D
from regscope.functions import keys as K
from regscope.functions.sniff import filetype


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


@pytest.mark.parametrize("raw,out", [
    ("2020-03-04", "2020-03-04"), ("2020-03", "2020-03-01"), ("2020", "2020-01-01"), ("", ""), (None, ""),
])
def test_normalise_date(spark, raw, out):
    assert one(spark, D.normalise_date("v"), raw) == out


@pytest.mark.parametrize("raw,out", [
    ("2020-03-04T09:30:00.123+01:00", "2020-03-04T09:30:00Z"),   # offset discarded, not applied
    ("2020-03-04T09:30:00Z", "2020-03-04T09:30:00Z"),
    ("2020-03-04", "2020-03-04T00:00:00Z"), ("2020-03", "2020-03-01T00:00:00Z"), ("2020", "2020-01-01T00:00:00Z"),
    ("", ""),
])
def test_normalise_timestamp(spark, raw, out):
    assert one(spark, D.normalise_timestamp("v"), raw) == out


@pytest.mark.parametrize("bad", ["2020-03-04T09:30:00", "20-3-4", "yesterday"])
def test_normalise_timestamp_strict_aborts(spark, bad):
    with pytest.raises(Exception, match="not a date"):
        one(spark, D.normalise_timestamp("v"), bad)


def test_normalise_lenient_gives_null(spark):
    assert one(spark, D.normalise_date("v", strict=False), "2020/01/02") is None


@pytest.mark.parametrize("raw,day", [
    ("2020-01-02T03:04:05Z", "2020-01-02"), ("2020-01-02", "2020-01-02"), ("2020-01", None), ("", None),
    ("2020-01-02xyz", None),
])
def test_sql_day(spark, raw, day):
    got = one(spark, D.sql_day("v"), raw)
    assert (str(got) if got else None) == day


def test_elapsed_days_truncates(spark):
    # 2002-12-30T12:00 -> 2003-01-01T00:00 is 1.5 days -> 1
    assert one(spark, D.elapsed_days("v", "2003-01-01T00:00:00Z"), "2002-12-30T12:00:00Z") == 1


def test_report_date_and_hour_version(spark):
    df = spark.range(1).select(D.report_date("2003-01-02T05:06:07Z").alias("d"),
                               D.hour_version_of("2003-01-01T05:59:59Z").alias("h"))
    r = df.first()
    assert r["d"] == "02-01-2003"
    assert r["h"] == 1041397200


def test_explode_list_blank_and_null(spark):
    df = spark.createDataFrame([("a", "x;y"), ("b", ""), ("c", None), ("d", "z;")], "k string, v string")
    out = sorted(tuple(r) for r in K.explode_list(df, "v", "item", keep=["k"]).collect())
    assert out == [("a", "x"), ("a", "y"), ("b", ""), ("d", ""), ("d", "z")]


def test_canonical_organisation_removes_every_occurrence(spark):
    assert one(spark, K.canonical_organisation("v"), "local-authority-eng:X-eng") == "local-authority:X"


def test_source_key(spark):
    df = spark.createDataFrame([("s1", "c", "o", "e"), ("", "c", "o", "e")], "source string, collection string, "
                               "organisation string, endpoint string")
    got = [r[0] for r in df.select(K.source_key()).collect()]
    import hashlib
    assert got == [hashlib.md5(b"c|o|e").hexdigest(), ""]


def test_default_dataset(spark):
    df = spark.createDataFrame([("", "p"), (None, "p"), ("d", "p")], "dataset string, pipeline string")
    assert [r[0] for r in df.select(K.default_dataset()).collect()] == ["p", "p", "d"]


def test_mapping_fields(spark):
    df = spark.createDataFrame([("Start_Date", "start-date"), ("WKT", "geometry"), ("ref no", "reference"),
                                (None, "point"), (None, "name")], "column string, field string")
    got = [tuple(r) for r in df.select(K.header_match(), K.mapping_field(), K.non_mapping_field()).collect()]
    assert got == [(True, "start-date", None), (False, "geometry", None), (False, None, "reference"),
                   (None, "point", None), (None, None, None)]


def test_organisation_slug(spark):
    assert one(spark, K.organisation_slug("v"), "local-authority:E1") == "/organisation/local-authority/E1"
    with pytest.raises(Exception, match="prefix:reference"):
        one(spark, K.organisation_slug("v"), "a:b:c")


@pytest.mark.parametrize("text,kind", [
    ("<!DOCTYPE html><html>", "html"), ("<?xml version='1.0'?>", "xml"), ("<wfs:FeatureCollection", "xml"),
    ('{"type": "x"}', "json"), ("PK\x03\x04rest", "zip"), ("SQLite format 3\x00...", "sqlite"),
    ("a,b,c\n1,2,3", "csv"), ("", "csv"),
])
def test_filetype(spark, text, kind):
    assert one(spark, filetype("v"), text) == kind


def test_filetype_bytes(spark):
    from regscope.functions.sniff import filetype_of_bytes
    df = spark.createDataFrame([(bytearray(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1xx"),)], "v binary")
    assert df.select(filetype_of_bytes("v")).first()[0] == "excel"


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata", "Europe/London"])
def test_dates_do_not_depend_on_session_zone(spark, zone):
    texts = [("2021-03-28T01:30:00Z",), ("2021-03-14T02:30:00.5+01:00",), ("2020-06",), ("2002-06-30T23:59:59Z",)]
    df = spark.createDataFrame(texts, "v string")

    def compute():
        return [tuple(r) for r in df.select(
            D.normalise_timestamp("v"), D.elapsed_days("v", "2003-01-01T00:00:00Z"),
            D.hour_version(F.lit("2024-01-01 05:59:59").cast("timestamp_ntz"))).collect()]

    expected = compute()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert compute() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert expected[0][0] == "2021-03-28T01:30:00Z" and expected[3][1] == 184
    assert expected[0][2] == 1704085200

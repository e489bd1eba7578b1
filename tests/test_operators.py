import pytest

from conftest import rows
from regscope.operators import aggregates as A
from regscope.operators import joins as J
from regscope.operators import setops as U
from regscope.operators import windows as W
from regscope.operators.quality import assert_no_extra_columns, check_columns, column_expectations, out_of_order


def test_top_by_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("k", "2020-01-02", "a", 1), ("k", "2020-01-02", "b", 2), ("k", "2020-01-01", "z", 3),
        ("n", None, "x", 4), ("n", None, "y", 5), ("m", None, "q", 6), ("m", "2019", "p", 7),
    ], "key string, d string, tie string, payload int")
    out = rows(A.top_by(df, "key", order=["d", "tie"], payload=["payload"]), "key", "d", "tie", "payload")
    # ties broken by the next column (desc); NULL is the smallest value
    assert out == [("k", "2020-01-02", "b", 2), ("m", "2019", "p", 7), ("n", None, "y", 5)]


def test_distinct_list_null_when_empty(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("b", None)], "k string, v string")
    assert rows(df.groupBy("k").agg(A.distinct_list("v").alias("l"))) == [("a", "x;y"), ("b", None)]


def test_drop_null_keys(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("b", None)], "x string, y string")
    assert rows(A.drop_null_keys(df, ["x", "y"])) == [("a", "1")]


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([("o1", "d1"), ("o2", None), ("o3", "d3")], "organisation string, dataset string")
    right = spark.createDataFrame([("o1", "d1", "e1"), ("o2", None, "e2")],
                                  "organisation string, pipeline string, endpoint string")
    out = J.null_safe_left_join(left, right, [("organisation", "organisation"), ("dataset", "pipeline")])
    assert out.columns == ["organisation", "dataset", "pipeline", "endpoint"]
    assert rows(out) == [("o1", "d1", "d1", "e1"), ("o2", None, None, "e2"), ("o3", "d3", None, None)]


def test_anti_join(spark):
    df = spark.createDataFrame([("r1",), ("r2",)], "resource string")
    old = spark.createDataFrame([("r2",), (None,)], "old_resource string")
    assert rows(J.anti_join(df, old, "resource", "old_resource"), "resource") == [("r1",)]


def test_repeated_rows(spark):
    df = spark.createDataFrame([
        ("f1", "1", "geometry", 10), ("f1", "1", "geometry", 11), ("f1", "1", "geometry", 12),
        ("f1", "2", "geometry", 13), ("f2", "1", "geometry", 14), ("f1", None, "name", 15), ("f1", None, "name", 16),
    ], "file string, row_number string, field string, line int")
    out = rows(W.repeated_rows(df, ["file"], ["row_number", "field"], "line"), "line")
    assert out == [(11,), (12,), (16,)]


@pytest.mark.parametrize("width", [1 << 20, 3])
def test_blank_delimited_groups(spark, width):
    data = [(1, "a", "A"), (2, "b", "B"), (3, "", ""), (4, "c", "C"), (5, "", ""), (6, "", ""), (7, "d", "D"),
            (8, "e", "E"), (9, "", ""), (10, "f", "F")]
    df = spark.createDataFrame(data, "pos long, slug string, name string")
    out = rows(W.blank_delimited_groups(df, "pos", ["slug", "name"], bucket_width=width), "pos", "group_id")
    assert out == [(1, 0), (2, 0), (4, 1), (7, 3), (8, 3), (10, 4)]


def test_union_by_name_widens(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2, 1.5)], "id bigint, score double")
    out = U.union_by_name([a, b])
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "string", "double"]
    assert rows(out, "id", "s", "score") == [(1, "x", None), (2, None, 1.5)]


def test_append_rows_blank_fill(spark):
    old = spark.createDataFrame([("a", "1")], "x string, y string")
    new = spark.createDataFrame([("b", "z")], "x string, w string")
    out = U.append_rows(old, new)
    assert rows(out, "x", "y", "w") == [("a", "1", ""), ("b", "", "z")]
    assert U.append_rows(None, new) is new


def test_concat_tables_loses_no_column(spark):
    a = spark.createDataFrame([("a", 1, "q")], "x string, n long, only_a string")
    b = spark.createDataFrame([(2, "b")], "n long, x string")
    out = U.concat_tables([a, b])
    assert out.columns == ["x", "n", "only_a"]
    assert rows(out) == [("a", 1, "q"), ("b", 2, "")]
    with pytest.raises(ValueError, match="only_a"):
        U.concat_tables([a, b], ["x", "n"])
    assert U.concat_tables([a, b], ["n", "absent", "only_a", "x"]).columns == ["n", "absent", "only_a", "x"]


def test_column_checks(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    res = {r["table_name"]: r for r in column_expectations(spark, {"t": df, "u": df}, {"t": ["x", "z"], "u": ["y"], "absent": ["x"]}).collect()}
    assert (res["t"]["present"], res["t"]["success"], res["t"]["missing"], res["t"]["actual"]) == (True, False, "z", "x;y")
    assert res["u"]["success"] and (res["absent"]["present"], res["absent"]["success"]) == (False, False)
    with pytest.raises(ValueError, match="absent: not found"):
        check_columns(spark, {"u": df}, {"u": ["y"], "absent": ["x"]})
    with pytest.raises(ValueError, match="undeclared"):
        assert_no_extra_columns(df, ["x"], "t")


def test_empty_inputs_are_clear_errors(spark):
    from regscope.operators.quality import table_inventory
    from regscope.plans.catalogue import slug_inventory
    for call in (lambda: U.union_by_name([]), lambda: U.concat_tables([]), lambda: table_inventory({}),
                 lambda: slug_inventory(), lambda: column_expectations(spark, {}, {})):
        with pytest.raises(ValueError):
            call()


def test_widening_follows_the_value_types(spark):
    from pyspark.sql import types as T
    w = U._wider
    assert w(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and w(T.BooleanType(), T.IntegerType()) == T.IntegerType()
    assert w(T.DecimalType(10, 2), T.IntegerType()) == T.DecimalType(12, 2) and w(T.DecimalType(5, 3), T.DecimalType(9, 1)) == T.DecimalType(11, 3)
    assert w(T.DecimalType(5, 3), T.DoubleType()) == T.DoubleType() and w(T.LongType(), T.StringType()) == T.StringType()
    assert w(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())) == T.ArrayType(T.LongType())


def test_configure_leaves_the_callers_join_settings(spark):
    from regscope.session import configure
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12345")
        assert configure(spark).conf.get("spark.sql.autoBroadcastJoinThreshold") == "12345"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_column_expectations_count_rows_and_empty_columns(spark):
    df = spark.createDataFrame([("a", "", None), ("b", "", None)], "x string, y string, z int")
    found = column_expectations(spark, {"t": df, "u": df.limit(0)}, {"t": ["x", "y", "z"], "u": ["x"], "absent": ["x"]}, count_rows=True)
    got = {r["table_name"]: (r["success"], r["row_count"], r["empty"]) for r in found.collect()}
    assert got == {"t": (True, 2, "y;z"), "u": (True, 0, "x"), "absent": (False, 0, "")}


def test_out_of_order(spark):
    data = [("a", 3), ("a", 2), ("a", 2), ("b", 9), ("b", 10), ("a", 1), (None, 5), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "at long, k string, n int")
    assert rows(out_of_order(df, "at", ["k", "n desc"]), "at") == [(4,), (5,), (6,)]
    assert out_of_order(df.where("at < 4"), "at", ["k", "n desc"]).isEmpty()

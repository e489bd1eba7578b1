"""CSV in blocks, running totals, ranged reads, type inference: against plain Python."""

import csv
import io
import os
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from regscope import sinks
from regscope.operators.scan import ordinals, running_sum
from regscope.operators.windows import blank_delimited_groups
from regscope.sources import csv as C
from regscope.sources import infer
from regscope.sources.blocks import cells, read_records
from regscope.sources.parquet import file_schemas, read_parquet_union
from regscope.sources.ranged import leading_bytes, list_files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def _table(rng, n):
    """CSV text whose cells hold breaks, quotes and separators, quoted or not."""
    def cell():
        if rng.random() < 0.4:
            return rng.choice(["a", "bb", "", '5" pipe', 'x"y"z', "it's", " lead", "é日本"])
        body = rng.choice(['say ""hi""', "two\nlines", "\n\n\n", "a,b,c", "", '""', "x\r\ny", '"",""\n"",', "long " * rng.randint(1, 40)])
        return '"' + body + '"' + rng.choice(["", "", "", "tail", 't"q'])
    out = []
    for _ in range(n):
        out.append(",".join(cell() for _ in range(rng.choice([1, 2, 5]))) + rng.choice(["\n", "\n", "\r\n"]))
        if rng.random() < 0.05:
            out.append("\n")
    return "".join(out)


def _read(spark, folder, block):
    got = {}
    for r in read_records(spark, f"{folder}/*.csv", block).select("file", "block", "n", cells(F.col("record")).alias("c")).collect():
        got.setdefault(os.path.basename(r["file"]), []).append(((r["block"], r["n"]), r["c"]))
    return {f: [c for _, c in sorted(v)] for f, v in got.items()}, sum(len({b for (b, _), _ in v}) for v in got.values())


@pytest.mark.parametrize("block", [None, 23, 300])
def test_records_equal_the_csv_modules(spark, scratch, block):
    rng = random.Random(7)
    texts = {f"f{i}.csv": _table(rng, n) for i, n in enumerate((1, 40, 200, 3))}
    for name, text in texts.items():
        _write(f"{scratch}/{name}", text)
    got, blocks = _read(spark, scratch, block)
    assert got == {n: [r for r in csv.reader(io.StringIO(t, newline="")) if r] for n, t in texts.items()}
    assert (blocks > 40) if block == 23 else blocks >= 4


@given(st.lists(st.lists(st.text('ab",\n é', max_size=6), min_size=1, max_size=3), min_size=1, max_size=12), st.sampled_from([3, 8, 30]))
@settings(max_examples=12, deadline=None)
def test_any_table_survives_any_block_size(spark, table, block):
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows(table)
    _write(f"{folder}/t.csv", out.getvalue())
    got, _ = _read(spark, folder, block)
    assert got.get("t.csv", []) == [r for r in csv.reader(io.StringIO(out.getvalue(), newline="")) if r]


def test_a_quote_that_is_never_closed_is_an_error(spark, scratch, monkeypatch):
    from regscope.sources import blocks

    monkeypatch.setattr(blocks, "MAX_RECORD", 500)
    _write(f"{scratch}/a.csv", 'x,y\n1,"open\n' + "2,3\n" * 300)
    with pytest.raises(ValueError, match="quote"):
        read_records(spark, f"{scratch}/a.csv", 64)


def test_block_size_is_the_sessions_again(spark, scratch):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    _write(f"{scratch}/a.csv", "x\n1\n")
    read_records(spark, f"{scratch}/a.csv", 64)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def _registry_file(folder, rng, n=120):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator="\n")
    w.writerow(["key", "note", "end-date"])
    for i in range(n):
        w.writerow([str(i), rng.choice(["", "plain", "two\nlines", 'a "q", b', "\n"]), rng.choice(["", "2020-01-02"])])
    return _write(f"{folder}/t.csv", out.getvalue())


def test_readers_give_the_same_rows_in_blocks(spark, scratch):
    path = _registry_file(scratch, random.Random(2))
    whole = rows(C.read_csv_text(spark, path))
    assert len(whole) == 120
    for block in (40, 1_000):
        assert rows(C.read_csv_text(spark, path, block_bytes=block)) == whole
        assert rows(C.read_csv_union(spark, path, block_bytes=block)) == whole
    one, two = (C.read_positioned_csv(spark, path, "pos", block_bytes=b).orderBy("pos").select("key").collect() for b in (None, 64))
    assert [r["key"] for r in one] == [r["key"] for r in two] == [str(i) for i in range(120)]


def test_large_files_are_read_by_more_tasks_than_files(spark, scratch):
    path = _registry_file(scratch, random.Random(3), 4_000)
    records = read_records(spark, path, 8 << 10)
    assert records.select("block").distinct().count() > 8
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        assert C._in_blocks(spark, path, None) and C.read_csv_text(spark, path).count() == 4_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not C._in_blocks(spark, path, None)


def test_headers_must_agree_or_be_matched_by_name(spark, scratch):
    _write(f"{scratch}/a/t.csv", "x,y\n1,2\n")
    _write(f"{scratch}/b/t.csv", "y,x,z\n3,4,5\n")
    with pytest.raises(ValueError, match="by name"):
        C.read_csv_text(spark, f"{scratch}/*/t.csv", block_bytes=8)
    assert rows(C.read_csv_union(spark, f"{scratch}/*/t.csv", block_bytes=8), "x", "y", "z") == [("1", "2", ""), ("4", "3", "5")]


def test_surplus_in_blocks(spark, scratch):
    _write(f"{scratch}/s.csv", 'a,b\n1,2\n1,2,3\nx\n"q,q",y\n')
    with pytest.raises(Exception, match="wider than its header"):
        C.read_csv_text(spark, f"{scratch}/s.csv", block_bytes=4).collect()
    assert rows(C.read_csv_text(spark, f"{scratch}/s.csv", surplus="quarantine", block_bytes=4)) == [("1", "2"), ("q,q", "y"), ("x", "")]


@pytest.mark.parametrize("width", [2, 7, 1 << 20])
def test_running_sum_of_any_depth(spark, width):
    rng = random.Random(width)
    at = sorted(rng.sample(range(900), 300))
    data = [(p, rng.choice([None, 0, 1, 5])) for p in at]
    df = spark.createDataFrame(data, "p long, v int").repartition(5)
    for inclusive in (False, True):
        total, want = 0, {}
        for p, v in data:
            want[p] = total + (v or 0) * inclusive
            total += v or 0
        found = running_sum(df, "p", "v", "s", width, inclusive)
        assert {r["p"]: r["s"] for r in found.collect()} == want
    assert running_sum(df.limit(0), "p", "v", "s", width).count() == 0


def test_no_window_is_without_a_partition(spark):
    df = spark.range(2_000).select(F.col("id").alias("pos"), F.when(F.col("id") % 9 == 0, "").otherwise("x").alias("slug"))
    for plan in (running_sum(df, "pos", "pos", "s", 16), blank_delimited_groups(df, "pos", ["slug"], 16)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Window" in text and "SinglePartition" not in text


def test_ordinals(spark):
    df = spark.createDataFrame([(f"k{i * 7 % 50}", i) for i in range(50)], "k string, n int").repartition(6)
    found = ordinals(df, ["k"], "at", 3).orderBy("at").collect()
    assert [r["at"] for r in found] == list(range(50)) and [r["k"] for r in found] == sorted(f"k{i}" for i in range(50))


def test_leading_bytes_read_no_content(spark, scratch):
    for i, body in enumerate((b"", b"abc", b"x" * 100_000)):
        with open(f"{scratch}/f {i}%20.bin", "wb") as f:
            f.write(body)
    found = leading_bytes(spark, list_files(spark, f"{scratch}/*.bin"), 64)
    assert sorted(bytes(r["head"]) for r in found.collect()) == [b"abc", b"x" * 64]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()


def test_stores_that_arrow_cannot_open(spark, scratch, monkeypatch):
    from regscope.sources import ranged

    spark.range(3).write.parquet(f"{scratch}/p/a")
    spark.range(3).selectExpr("CAST(id AS int) AS id", "id > 1 AS f").write.parquet(f"{scratch}/p/b")
    _write(f"{scratch}/t/x.txt", "<?xml version")
    want = sorted(r["schema"] for r in file_schemas(spark, f"{scratch}/p").collect())
    monkeypatch.setattr(ranged, "ARROW_SCHEMES", {})
    assert sorted(r["schema"] for r in file_schemas(spark, f"{scratch}/p").collect()) == want
    assert rows(C.sniff_files(spark, f"{scratch}/t/*"), "filetype") == [("xml",)]


def test_thousands_of_parquet_files_without_a_driver_loop(spark, scratch, monkeypatch):
    for i in range(2_000):
        fields = {"id": pa.array([i], pa.int32() if i % 2 else pa.int64())}
        if i % 3 == 0:
            fields["score"] = pa.array([0.5], pa.float32() if i % 2 else pa.float64())
        pq.write_table(pa.table(fields), f"{scratch}/{i:05}.parquet")
    assert file_schemas(spark, scratch).select("schema").distinct().count() == 4
    reads = []
    own = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: reads.append(p) or own(self, *p, **k))
    df = read_parquet_union(spark, scratch)
    assert len(reads) <= 3 and all(len(p) == 1 for p in reads)  # folders, never lists of files
    assert df.schema.simpleString() == "struct<id:bigint,score:double>"
    assert df.agg(F.count("*"), F.sum("id"), F.count("score")).first()[:] == (2_000, 1_999_000, 667)


def test_parquet_types_that_must_be_cast(spark, scratch):
    spark.createDataFrame([(True, 1)], "f boolean, n int").write.parquet(f"{scratch}/p/a")
    spark.createDataFrame([(2, "x")], "f int, n string").write.parquet(f"{scratch}/p/b")
    df = read_parquet_union(spark, f"{scratch}/p")
    assert dict(df.dtypes) == {"f": "int", "n": "string"} and rows(df) == [(1, "1"), (2, "x")]


def test_header_report_before_anything_is_read(spark, scratch):
    _write(f"{scratch}/tree/aa.csv", '"field",value,"odd\nname"\r\nx,1,2\n')
    _write(f"{scratch}/area/bb.csv", "value,field\n1,x\n")
    _write(f"{scratch}/area/cc.csv", "")
    found = C.undeclared_columns(spark, f"{scratch}/*/*.csv", ["field", "value"])
    assert [(os.path.basename(r["path"]), r["column"]) for r in found.collect()] == [("aa.csv", "odd\nname")]
    assert rows(C.file_headers(spark, f"{scratch}/area/bb.csv"), "position", "column") == [(0, "value"), (1, "field")]


def test_types_are_the_narrowest(spark, scratch):
    head = "i,l,d,day,at,b,mixed,blank,text,huge"
    body = ["1,3000000000,1.5,2020-01-02,2020-01-02T03:04:05Z,true,1,,007x,99999999999999999999", "-7,4,2e3,2021-02-28,2020-01-02,FALSE,x,,1,1", ",,,,,,,,,"]
    path = _write(f"{scratch}/t.csv", "\n".join([head, *body]) + "\n")
    text = C.read_csv_text(spark, path)
    kinds = {n: t.simpleString() for n, t in infer.infer_types(text).items()}
    assert kinds == {"i": "int", "l": "bigint", "d": "double", "day": "date", "at": "timestamp", "b": "boolean", "mixed": "string", "blank": "string",
                     "text": "string", "huge": "double"}
    assert dict(C.read_csv_typed(spark, path).dtypes) == kinds
    assert text.agg(*[F.bit_and(infer.readable_as(F.col("i")))]).first()[0] is not None
    assert isinstance(infer.infer_types(text.limit(0))["i"], T.StringType)


def test_types_equal_duckdbs(spark, scratch):
    rng = random.Random(4)
    lines = ["n,x,day,flag,name"] + [f"{rng.randint(-9, 10**12)},{rng.random()},2020-0{rng.randint(1, 9)}-1{rng.randint(0, 9)},{rng.choice(['true', 'false'])},v{i}" for i in range(200)]
    path = _write(f"{scratch}/t.csv", "\n".join(lines) + "\n")
    want = {c: t for c, t, *_ in duckdb.sql(f"DESCRIBE SELECT * FROM read_csv('{path}')").fetchall()}
    assert want == {"n": "BIGINT", "x": "DOUBLE", "day": "DATE", "flag": "BOOLEAN", "name": "VARCHAR"}
    df = C.read_csv_typed(spark, path)
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "day": "date", "flag": "boolean", "name": "string"}
    assert rows(df) == sorted(duckdb.sql(f"SELECT * FROM read_csv('{path}')").fetchall())


def test_typed_reading_scans_the_files_once(spark, scratch):
    path = _write(f"{scratch}/t.csv", "a,b\n1,x\n")
    df = C.read_csv_typed(spark, path)
    os.unlink(path)
    assert rows(df) == [(1, "x")]


def test_appends_are_by_name_and_refuse_other_columns(spark):
    name = "appended_" + os.urandom(6).hex()
    df = spark.createDataFrame([("a", 1)], "x string, n int")
    sinks.save_append(df, name)
    sinks.save_append(df.select("n", "x"), name)
    with pytest.raises(ValueError, match="columns"):
        sinks.save_append(df.withColumn("more", F.lit(1)), name)
    with pytest.raises(ValueError, match="columns"):
        sinks.save_append(df.drop("n"), name)
    assert rows(spark.table(name)) == [("a", 1), ("a", 1)]
    sinks.create_table_as(spark, f"{name}_2", f"SELECT x, sum(n) AS n FROM {name} GROUP BY x")
    assert rows(spark.table(f"{name}_2")) == [("a", 2)]


def test_written_order_is_the_order_asked_for(spark, scratch):
    from regscope.operators.quality import out_of_order

    df = spark.range(3_000).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") * 37 % 1009).alias("n")).repartition(6)
    path = sinks.write_csv(df, ["k", "n"], f"{scratch}/s.csv", sort_by=["k", "n desc"], rows_per_file=400)
    back = ordinals(C.read_positioned_csv(spark, path, "__pos"), ["__pos"], "at").withColumn("n", F.col("n").cast("long"))
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) > 1
    assert out_of_order(back, "at", ["k", "n desc"]).isEmpty() and not out_of_order(back, "at", ["n"]).isEmpty()


def test_latest_log_reads_only_the_months_it_needs(spark, scratch):
    from regscope.plans import registry as reg

    data = [(f"e{i % 5}", f"20{10 + i % 9}-0{1 + i % 9}-1{i % 9}T00:00:0{i % 10}Z", "200", "", f"r{i}") for i in range(300)] + [("e0", "not-a-date", "", "", ""), ("dead", "?", "", "", "")]
    log = spark.createDataFrame(data, "endpoint string, entry_date string, status string, exception string, resource string")
    path = sinks.write_by(reg.log_by_month(log), ["month"], f"{scratch}/log.parquet")
    found = reg.most_recent_log_by_month(spark.read.parquet(path))
    assert rows(found, *log.columns) == rows(reg.most_recent_log(log), *log.columns)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_reports_by_name_equal_the_dataframe_reports(spark):
    from regscope.fixtures import Fixtures
    from regscope.plans import by_name
    from regscope.plans import catalogue as cat
    from regscope.plans import performance as perf
    from regscope.plans import registry as reg
    from regscope.sources.registry import register_tables

    t = Fixtures(spark, "/root/testdata/sf0.001").registry_tables()
    register_tables(spark, {f"by_name_{n}": df for n, df in t.items()})
    for name, want in (("reporting_historic_endpoints", reg.historic_endpoints(t, "reporting")), ("provision_data", perf.provision_data(t["provision"], t["organisation"])),
                       ("active_resources", cat.active_resources(t["resource"]))):
        got = by_name.report(spark, name, "by_name_")
        assert sorted(got.columns) == sorted(want.columns) and want.exceptAll(got.select(*want.columns)).isEmpty() and got.count() == want.count()

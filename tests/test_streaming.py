import os

from conftest import rows
from regscope.plans.build import ISSUE_FIELDS
from regscope.streaming.landing import append_landed


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_append_landed_processes_each_file_once(spark, scratch):
    src, out, ck = f"{scratch}/var/issue", f"{scratch}/issue", f"{scratch}/ck"
    header = ",".join(ISSUE_FIELDS) + "\n"
    _write(f"{src}/tree/aa.csv", header + "x,y,1,geometry,missing,,,tree,,1,\n")
    _write(f"{src}/area/bb.csv", header + "x,y,2,name,invalid,v,,area,,2,\n")
    append_landed(spark, src, out, ISSUE_FIELDS, "pipeline", ck).awaitTermination()
    assert rows(spark.read.parquet(out), "pipeline", "resource", "field") == [
        ("area", "bb", "name"), ("tree", "aa", "geometry")]
    _write(f"{src}/tree/cc.csv", header + ",,3,reference,missing,,,tree,,3,\n")
    append_landed(spark, src, out, ISSUE_FIELDS, "pipeline", ck).awaitTermination()
    got = rows(spark.read.parquet(out), "pipeline", "resource", "row-number", "value")
    assert got == [("area", "bb", "2", "v"), ("tree", "aa", "1", ""), ("tree", "cc", "3", "")]


def test_a_later_run_without_a_checkpoint_argument_goes_on(spark, scratch):
    src, out = f"{scratch}/var/issue", f"{scratch}/issue"
    header = ",".join(ISSUE_FIELDS) + "\n"
    _write(f"{src}/tree/aa.csv", header + "x,y,1,geometry,missing,,,tree,,1,\n")
    append_landed(spark, src, out, ISSUE_FIELDS, "pipeline").awaitTermination()
    _write(f"{src}/tree/cc.csv", header + ",,3,reference,missing,,,tree,,3,\n")
    append_landed(spark, src, out, ISSUE_FIELDS, "pipeline").awaitTermination()
    assert rows(spark.read.parquet(out), "resource", "row-number") == [("aa", "1"), ("cc", "3")]

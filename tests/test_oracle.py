"""Every registered query against its DuckDB oracle on the smallest fixture scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from regscope.fixtures import TABLES
from regscope.queries import QUERIES

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("\x1f".join(_norm(r[i]) for i in order) for r in data)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_the_star_keeps_every_row(duck):
    """The key's statement against a count that multiplies instead of joining."""
    star = duck.execute(f"SELECT count(*) FROM ({entry.oracle_sql()['log_star']})").fetchone()[0]
    by_log = duck.execute(entry.oracle_sql()["most_recent_log"]).fetchall()
    assert star > len(by_log) and duck.execute("SELECT count(*) FROM lineitem").fetchone()[0] > 0


@pytest.mark.parametrize("key, column, values", [
    ("unmapped_resources", "reason", {"no-endpoint", "no-pipeline", "blank-pipeline"}),
    ("sniff_filetype", "filetype", {"excel", "zip", "sqlite", "html", "xml", "json", "csv"}),
    ("days_since_200", "days_since_200", {None}),
    ("column_expectations", "success", {True, False}),
    ("canonical_organisation", "organisation", {"-eng-eng"}),
])
def test_fixtures_reach_every_branch(key, column, values):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    got = {r[0] for r in con.execute(f"SELECT DISTINCT {column} FROM ({entry.oracle_sql()[key]})").fetchall()}
    assert all(v in got or any(isinstance(v, str) and v in str(g) for g in got) for v in values)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    r = df.collect()
    assert len(r) == 69
    assert sum(x["active_endpoint_count"] for x in r) > 0

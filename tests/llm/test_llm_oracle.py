"""The corpus queries that have SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from regscope.llm.oracle import ORACLE
from regscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[key])
    columns = [d[0] for d in cur.description]
    def text(row):
        return tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)
    want = sorted(text(r) for r in cur.fetchall())
    df = QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(text(r) for r in df.select(*columns).collect()) == want

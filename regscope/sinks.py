"""Sinks: Parquet per table, header CSV with a fixed column order, managed
tables, strict-column writes, and lineage cuts into the shared checkpoint folder.

Writers produce one part file per task (a folder per table); nothing is
funnelled through a single task to make "one file".
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from regscope.operators.quality import assert_no_extra_columns
from regscope.session import ensure_checkpoint_dir


def ordered(df: DataFrame, sort_by: Sequence | None) -> DataFrame:
    """O1: a report's ORDER BY, applied only at the sink (a range-partitioned
    global sort; part files are written in order). ``sort_by`` items are column
    names, ``"name desc"`` strings, or Columns."""
    if not sort_by:
        return df
    from pyspark.sql import functions as F

    def key(k):
        if isinstance(k, str) and k.lower().endswith(" desc"):
            return F.desc(k[:-5].strip())
        return k
    return df.orderBy(*[key(k) for k in sort_by])


def write_parquet(df: DataFrame, name: str, out_dir: str, mode: str = "overwrite",
                  sort_by: Sequence | None = None) -> str:
    """K1: ``<out_dir>/<name>.parquet``."""
    path = f"{out_dir.rstrip('/')}/{name}.parquet"
    ordered(df, sort_by).write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, columns: Sequence[str], path: str, mode: str = "overwrite",
              sort_by: Sequence | None = None, rows_per_file: int = 0) -> str:
    """K2: header CSV with the declared column order (absent columns blank).
    ``rows_per_file`` limits a part's rows (0: no limit)."""
    from regscope.plans.consolidate import project_declared

    out = ordered(project_declared(df, columns), sort_by)
    (out.write.mode(mode).option("header", True).option("escape", '"').option("maxRecordsPerFile", rows_per_file)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def save_replace(df: DataFrame, name: str) -> str:
    """K3/K4/K5: replace a managed table (create-if-absent + append after a
    delete is the same net effect)."""
    df.write.mode("overwrite").saveAsTable(name)
    return name


def write_by(df: DataFrame, keys: Sequence[str], path: str, mode: str = "overwrite") -> str:
    """Parquet in a folder per value of ``keys``, so that readers skip folders. Rows of a
    folder come together first (few files), and a large folder's are split among tasks."""
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)
    return path


def create_table_as(spark: SparkSession, name: str, select: str) -> str:
    """K5: ``CREATE TABLE name AS select``; a table of that name is an error."""
    spark.sql(f"CREATE TABLE {name} USING parquet AS {select}")
    return name


def save_append(df: DataFrame, name: str) -> str:
    """K4: create the managed table if absent, else append to it, by column name. Rows
    whose columns are not the table's are refused: none is dropped or left NULL."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        have = spark.table(name).columns
        if set(have) != set(df.columns):
            raise ValueError(f"{name} has columns {sorted(have)}, the rows {sorted(df.columns)}")
        df.select(*have).write.mode("append").saveAsTable(name)
    else:
        df.write.mode("errorifexists").saveAsTable(name)
    return name


def write_strict(df: DataFrame, columns: Sequence[str], path: str, table: str = "table") -> str:
    """K6: refuse a frame that carries a column outside the declared list."""
    assert_no_extra_columns(df, columns, table)
    return write_csv(df, columns, path)


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return a DataFrame reading it back: a
    lineage cut that survives executor loss (unlike a local checkpoint), and
    lets several reports reuse one computed intermediate."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/regscope/{name or 'table'}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)

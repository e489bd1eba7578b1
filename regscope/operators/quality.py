"""Data-quality checks over report frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def column_expectations(spark: SparkSession, reports: Mapping[str, DataFrame],
                        expected: Mapping[str, Sequence[str]], count_rows: bool = False) -> DataFrame:
    """One row per expected table: whether it is there, whether it has all expected
    columns (extra columns are tolerated; an absent table fails), the missing and
    the actual columns (``;``-joined). Only schemas are looked at, and no report runs,
    unless ``count_rows`` asks for the reports' rows too: their number, and which of
    the expected columns that are there hold nothing but NULL or blank."""
    if not expected:
        raise ValueError("no table is expected")
    rows = []
    for table, cols in expected.items():
        df = reports.get(table)
        actual = [] if df is None else list(df.columns)
        missing = [c for c in cols if c not in actual]
        rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(df is not None).alias("present"), F.lit(df is not None and not missing).alias("success"),
                             F.lit(";".join(missing)).alias("missing"), F.lit(";".join(actual)).alias("actual")))
    schemas = spark.range(1).select(F.inline(F.array(*rows)))
    if not count_rows:
        return schemas
    parts = []
    for table in expected:
        df = reports.get(table)
        if df is None:
            continue
        filled = [F.max(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) != "").alias(f"c{i}") for i, c in enumerate(expected[table]) if c in df.columns]
        names = [c for c in expected[table] if c in df.columns]
        empty = F.array_compact(F.array(*[F.when(F.coalesce(F.col(f"c{expected[table].index(c)}"), F.lit(False)), F.lit(None)).otherwise(F.lit(c)) for c in names]))
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), *filled).select(
            F.lit(table).alias("__t"), "row_count", F.array_join(empty, ";").alias("empty")))
    if not parts:
        return schemas.select("*", F.lit(0).cast("bigint").alias("row_count"), F.lit("").alias("empty"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return schemas.join(counts, F.col("table_name") == F.col("__t"), "left").select(
        *schemas.columns, F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"), F.coalesce("empty", F.lit("")).alias("empty"))


def check_columns(spark: SparkSession, reports: Mapping[str, DataFrame], expected: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q1 as a gate: the column check, raising when a table is absent or misses a
    column (the result is one small row per table; only it reaches the driver)."""
    result = column_expectations(spark, reports, expected)
    failed = [r for r in result.where(~F.col("success")).collect()]
    if failed:
        detail = "; ".join(f"{r['table_name']}: " + (f"lacks {r['missing']} (has {r['actual']})" if r["present"] else "not found") for r in failed)
        raise ValueError(f"report columns are incomplete: {detail}")
    return result


def out_of_order(rows: DataFrame, at: str, keys: Sequence[str]) -> DataFrame:
    """O1 checked: rows that come before their predecessor by ``keys`` (names, or
    ``"name desc"``). ``at`` numbers rows 0, 1, 2, .. in the order they were read
    (``operators.scan.ordinals``), so neighbours meet in an equi-join."""
    names = [k[:-5].strip() if k.lower().endswith(" desc") else k for k in keys]
    down = [k.lower().endswith(" desc") for k in keys]
    ahead = rows.select((F.col(at) + 1).alias("__at"), *[F.col(f"`{n}`").alias(f"__k{i}") for i, n in enumerate(names)])
    wrong, same = F.lit(False), F.lit(True)
    for i, (n, desc) in enumerate(zip(names, down, strict=True)):
        before, now = F.col(f"__k{i}"), F.col(f"`{n}`")
        # NULL comes first in ascending order, last in descending order
        late = (before < now) | (before.isNull() & now.isNotNull()) if desc else (before > now) | (before.isNotNull() & now.isNull())
        wrong = wrong | (same & F.coalesce(late, F.lit(False)))
        same = same & before.eqNullSafe(now)
    return rows.join(ahead, F.col(at) == F.col("__at")).where(wrong).select(*rows.columns)


def assert_no_extra_columns(df: DataFrame, declared: Sequence[str], table: str = "table") -> DataFrame:
    """Raise when a frame carries a column outside the declared list."""
    extra = [c for c in df.columns if c not in declared]
    if extra:
        raise ValueError(f"{table} has undeclared columns: {extra}")
    return df


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named table (one UNION ALL of one-row aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    if not parts:
        raise ValueError("table_inventory needs at least one table")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

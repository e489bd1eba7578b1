"""Consolidation of landed per-collection tables (the row transform applied
while concatenating CSV files) and the path-keyed partitions.

``consolidate`` is one ``select``: surrogate source key, default dataset,
date normalisation and projection onto the declared fields happen in a single
narrow stage, pipelined with the scan — no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regscope.functions.dates import normalise_date, normalise_timestamp
from regscope.functions.keys import default_dataset, source_key

# Fixed value: the partition path pattern ``.../<dir key>/<hex hash>.csv``; a table that
# Spark wrote is a folder of that name, with parts in it.
PATH_PATTERN = r"/([a-zA-Z0-9_-]+)/([a-f0-9]+)\.csv(?:/[^/]+)?$"


def is_timestamp_column(name: str) -> bool:
    return name in ("entry-date", "entry_date")


def is_date_column(name: str) -> bool:
    return not is_timestamp_column(name) and (name.endswith("-date") or name.endswith("_date"))


def normalise_dates(df: DataFrame, strict: bool = True) -> DataFrame:
    """Entry date -> ISO timestamp text, every other ``*-date``/``*_date`` -> ISO date text."""
    out = []
    for c in df.columns:
        if is_timestamp_column(c):
            out.append(normalise_timestamp(F.col(f"`{c}`"), strict).alias(c))
        elif is_date_column(c):
            out.append(normalise_date(F.col(f"`{c}`"), strict).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def project_declared(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Declared fields in declared order; extra columns dropped, absent ones ``''``."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{f}`") if f in have else F.lit("").alias(f) for f in fields])


def consolidate(df: DataFrame, table: str, fields: Sequence[str], strict: bool = True) -> DataFrame:
    """The per-row consolidation of one registry table.

    * ``source`` table: a row with a source id gets ``md5(collection|organisation|endpoint)``;
    * a declared ``dataset`` left blank takes the pipeline;
    * dates normalised (entry date as timestamp);
    * projected onto ``fields``.
    """
    cols: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    if table == "source" and "source" in cols:
        cols["source"] = source_key(*[cols.get(c, F.lit("")) for c in
                                      ("source", "collection", "organisation", "endpoint")])
    if "dataset" in fields:
        cols["dataset"] = default_dataset(cols.get("dataset", F.lit("")), cols.get("pipeline", F.lit("")))
    staged = df.select(*[v.alias(k) for k, v in cols.items()])
    if strict:
        # date columns that are not declared are dropped by the projection, but an
        # unknown shape in them still aborts (as in the reference); a validating
        # filter keeps Catalyst from pruning them away unchecked
        dropped = [c for c in staged.columns if c not in fields and (is_timestamp_column(c) or is_date_column(c))]
        if dropped:
            ok = None
            for c in dropped:
                norm = normalise_timestamp(F.col(f"`{c}`"), True) if is_timestamp_column(c) else \
                    normalise_date(F.col(f"`{c}`"), True)
                # always true, but not provably so for the optimizer: evaluated (and may abort) per row
                check = F.length(F.coalesce(norm, F.lit(""))) >= 0
                ok = check if ok is None else (ok & check)
            staged = staged.where(ok)
    return project_declared(normalise_dates(staged, strict), fields)


def consolidate_quarantine(df: DataFrame, table: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``consolidate`` without aborting: returns (good rows consolidated, bad
    rows as they came in, with ``bad_columns`` naming the date columns whose
    shape is unknown). One pass decides each row; nothing is collected."""
    dates = [c for c in df.columns if is_timestamp_column(c) or is_date_column(c)]
    checks = []
    for c in dates:
        norm = normalise_timestamp(F.col(f"`{c}`"), False) if is_timestamp_column(c) else \
            normalise_date(F.col(f"`{c}`"), False)
        checks.append(F.when(norm.isNull(), F.lit(c)))
    flagged = df.withColumn("bad_columns", F.concat_ws(";", *checks) if checks else F.lit(""))
    good = flagged.where(F.col("bad_columns") == "").drop("bad_columns")
    bad = flagged.where(F.col("bad_columns") != "")
    return consolidate(good, table, fields), bad


def with_path_keys(df: DataFrame, path_col: str = "path", strict: bool = True) -> DataFrame:
    """Add ``path_key`` (directory name) and ``path_hash`` (file stem) from the file path.

    A path that does not have the ``<key>/<hex>.csv`` shape aborts when
    ``strict`` (the reference cannot proceed either), else gives NULLs.
    """
    p = F.col(path_col)
    ok = p.rlike(PATH_PATTERN)
    key = F.when(ok, F.regexp_extract(p, PATH_PATTERN, 1))
    hsh = F.when(ok, F.regexp_extract(p, PATH_PATTERN, 2))
    if strict:
        err = F.raise_error(F.concat(F.lit("path does not name <key>/<hash>.csv: "), p)).cast("string")
        key = F.when(ok, key).otherwise(err)
    return df.withColumn("path_key", key).withColumn("path_hash", hsh)


def override_from_path(df: DataFrame, key_column: str, path_col: str = "path") -> DataFrame:
    """Issue / column-field partitions: the directory names the ``key_column``
    (pipeline or dataset) and the file stem names the resource; both override
    whatever the rows say."""
    k = with_path_keys(df, path_col)
    return (k.withColumn(key_column, F.col("path_key")).withColumn("resource", F.col("path_hash"))
            .drop("path_key", "path_hash"))


def path_mismatches(df: DataFrame, key_column: str = "dataset", path_col: str = "path") -> DataFrame:
    """Converted-resource partitions: rows whose dataset or resource differs from
    what the path says (one row per differing field; the rows are still kept
    in the consolidated table)."""
    k = with_path_keys(df, path_col)
    checks = F.array(
        F.struct(F.lit(key_column).alias("field"), F.col("path_key").alias("dir_value"),
                 F.col(key_column).alias("file_value")),
        F.struct(F.lit("resource").alias("field"), F.col("path_hash").alias("dir_value"),
                 F.col("resource").alias("file_value")))
    e = k.select(path_col, F.explode(checks).alias("__c")).select(path_col, "__c.*")
    return e.where(~F.col("dir_value").eqNullSafe(F.col("file_value")))

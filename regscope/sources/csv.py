"""CSV sources for landed registry files.

Registry CSVs are all text: header row, RFC-4180 quoting (embedded newlines
allowed), an empty cell means ``''``. Spark's CSV reader turns empty cells
into NULL, so every reader here ends with blanks for NULL in string columns.

A row with more cells than its header is an error (``surplus="raise"``) or is
left to the caller (``surplus="quarantine"``, see ``surplus_cells``): its extra
cells are never dropped without a word. Short rows are filled with blanks.

Files of one table may disagree on header order or width. ``read_csv_union``
reads all of them once, without a header and by position, writes the cells to
the shared folder, takes every file's first row as its header there, and matches
cells to columns by name with a join on the file. Only the distinct header names
reach the driver, however many files there are.

Spark's reader takes a file with quoted line breaks as one task. Where a file is
larger than one task's input (``spark.sql.files.maxPartitionBytes``), or where
``block_bytes`` asks for it, files are cut into blocks instead (``sources.blocks``),
with the same rows as the result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regscope.operators.scan import ordinals, running_sum
from regscope.sources.blocks import cells as cells_of
from regscope.sources.blocks import read_records
from regscope.sources.ranged import leading_bytes, list_files

PATH_COLUMN = "__path"
#: Cells a row may have in a by-name union; a wider row is an error. And room
#: beyond the first file's width that costs no second reading.
MAX_CELLS = 4096
SPARE_CELLS = 8
#: Files whose headers one task writes.
FEW_FILES = 10_000
_CORRUPT = "__corrupt"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _csv_reader(spark: SparkSession):
    return (spark.read.option("header", True).option("multiLine", True)
            .option("escape", '"').option("quote", '"'))


def _task_bytes(spark: SparkSession) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) << (10 * " kmgtp".index(unit or " "))


def _in_blocks(spark: SparkSession, paths, block_bytes: int | None) -> bool:
    """Are files to be cut into blocks? If asked to, or if some file is more than a task's input."""
    if block_bytes is not None:
        return True
    limit = _task_bytes(spark)
    # all files together, from the listing that any read begins with: no job for small tables
    if spark.read.text(_paths(paths))._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit:
        return False
    return (list_files(spark, paths).agg(F.max("length")).first()[0] or 0) > limit


def blank_for_null(df: DataFrame) -> DataFrame:
    """CSV semantics: an absent/empty text cell is ``''``, never NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=strings) if strings else df


def _is_surplus(record: str, width: int):
    """Does a raw record hold more than ``width`` cells? (commas outside quotes)"""
    bare = F.regexp_replace(F.col(record), r'"(?:[^"]|"")*+"', "")
    return F.coalesce(F.regexp_count(bare, F.lit(",")) >= width, F.lit(False))


def _with_record(spark: SparkSession, paths) -> DataFrame:
    """Rows with their raw record where it does not have as many cells as the header."""
    names = _csv_reader(spark).csv(_paths(paths)).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
    return _csv_reader(spark).schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).csv(_paths(paths))


def _first_records(records: DataFrame) -> DataFrame:
    """(file, header, at): each file's first record and where it is. Numbers are compared,
    not texts; what is found is written, one row a file, so that no join moves the records."""
    from regscope.sinks import materialize

    block = materialize(records.groupBy("file").agg(F.min("block").alias("block")), "csv-first-block")
    at = materialize(records.join(block, ["file", "block"]).groupBy("file", "block").agg(F.min("n").alias("n")), "csv-first")
    return materialize(records.join(at, ["file", "block", "n"]).select("file", F.col("record").alias("header"), F.struct("block", "n").alias("at")), "csv-header")


def _with_record_in_blocks(spark: SparkSession, paths, block_bytes: int | None) -> DataFrame:
    """As ``_with_record``, from files cut into blocks; and each row's file."""
    from regscope.sinks import materialize

    records = materialize(read_records(spark, paths, block_bytes), "csv-records")
    first = _first_records(records)
    headers = first.select("header").distinct().take(2)
    if not headers:
        raise ValueError(f"no CSV file with a header under {paths}")
    if len(headers) > 1:
        raise ValueError("the files' headers differ: read them by name (read_csv_union)")
    names = spark.range(1).select(cells_of(F.lit(headers[0]["header"])).alias("c")).first()["c"]
    rows = records.join(first.drop("header"), "file").where(F.struct("block", "n") > F.col("at"))
    plain = [f"c{i}" for i in range(len(names))]
    # the parser of Spark's own reader, on single records
    schema = ", ".join(f"{c} string" for c in [*plain, _CORRUPT])
    options = {"multiLine": "true", "escape": '"', "quote": '"', "columnNameOfCorruptRecord": _CORRUPT, "maxCharsPerColumn": "-1"}
    rows = rows.select(F.from_csv("record", schema, options).alias("r"), F.col("file").alias(PATH_COLUMN))
    return rows.select(*[F.col(f"r.{p}").alias(n) for p, n in zip(plain, names, strict=True)], F.col(f"r.{_CORRUPT}").alias(_CORRUPT), PATH_COLUMN)


def read_csv_text(spark: SparkSession, paths, with_path: bool = False, surplus: str = "raise", block_bytes: int | None = None) -> DataFrame:
    """S1: header CSV, every column text, ``''`` for blanks.

    All ``paths`` must share one header (see ``read_csv_union`` otherwise).
    ``with_path`` adds the source file as ``__path``. ``block_bytes`` cuts files
    into blocks of this size, whatever their size.
    """
    blocked = _in_blocks(spark, paths, block_bytes)
    df = _with_record_in_blocks(spark, paths, block_bytes) if blocked else _with_record(spark, paths).withColumn(PATH_COLUMN, F.col("_metadata.file_path"))
    return _checked(df, with_path, surplus)


def _checked(df: DataFrame, with_path: bool, surplus: str) -> DataFrame:
    """Rows without their raw record; surplus cells raise, or set a row aside."""
    path = [F.col(PATH_COLUMN)] if with_path else []
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != PATH_COLUMN], *path)
    names = [c for c in df.columns if c not in (_CORRUPT, PATH_COLUMN)]
    width = len(names)
    # a query may not refer to the record column alone: always true, but of a cell
    cell = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    over = _is_surplus(_CORRUPT, width)
    if surplus == "raise":
        df = df.where(F.when(over, F.raise_error(F.concat(F.lit("row wider than its header: "), F.substring(_CORRUPT, 1, 200))).cast("boolean"))
                      .otherwise(cell))
    elif surplus == "quarantine":
        df = df.where(~over & cell)
    else:
        raise ValueError("surplus is 'raise' or 'quarantine'")
    return blank_for_null(df.select(*[F.col(f"`{c}`") for c in names], *path))


def surplus_cells(spark: SparkSession, paths, block_bytes: int | None = None) -> DataFrame:
    """What ``surplus="quarantine"`` leaves out: (file, row, cells), the cells of each row
    that is wider than its file's header, as a JSON list; rows are numbered from the header, 0."""
    cells = _cells(spark, paths, block_bytes)
    if cells is None:
        return spark.createDataFrame([], "file string, row bigint, cells string")
    heads = cells.groupBy(F.col("file").alias("__f")).agg(F.min("rid").alias("__first"), F.min_by(F.size("cells"), "rid").alias("__width"))
    wide = cells.join(heads, F.col("file") == F.col("__f")).where(F.size("cells") > F.col("__width"))
    return wide.select("file", (F.col("rid") - F.col("__first")).alias("row"), F.to_json(F.transform("cells", lambda c: F.coalesce(c, F.lit("")))).alias("cells"))


def read_csv_typed(spark: SparkSession, path, schema: T.StructType | str | None = None, block_bytes: int | None = None) -> DataFrame:
    """S5: CSV with column types, from an explicit schema, or each column's narrowest.
    The files are read and parsed once: their text is written to the shared folder, and
    both the types (one aggregate) and the rows come from there."""
    from regscope.sinks import materialize
    from regscope.sources.infer import infer_types, typed

    if schema is not None:
        return _csv_reader(spark).schema(schema).csv(_paths(path))
    text = materialize(read_csv_text(spark, path, block_bytes=block_bytes), "csv-text")
    return typed(text, infer_types(text))


def _cells_in_blocks(spark: SparkSession, paths, block_bytes: int | None) -> DataFrame:
    """As ``_cells``, from files cut into blocks. A block's rows are numbered from where
    the blocks before it end."""
    from regscope.sinks import materialize

    every = read_records(spark, paths, block_bytes).select("file", "block", "n", cells_of(F.col("record")).alias("cells"))
    # blank cells at a row's end are no cells, as in ``_cells``
    filled = F.array_position(F.transform(F.reverse("cells"), lambda c: c != ""), True)
    used = F.when(filled > 0, F.size("cells") - filled + 1).otherwise(0).cast("int")
    rows = materialize(every.withColumn("cells", F.slice("cells", F.lit(1), used)), "csv-cells")
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("file", "block").agg((F.max("n") + 1).alias("span"))
    spans = spans.select("file", "block", F.coalesce(F.sum("span").over(along), F.lit(0)).alias("start"))
    return rows.join(spans, ["file", "block"]).select("file", (F.col("start") + F.col("n")).alias("rid"), "cells")


def _cells(spark: SparkSession, paths, block_bytes: int | None = None) -> DataFrame | None:
    """(file, rid, cells) of every record of every file, headers included. Room is
    made for a few cells more than the first file has; only if some row needs still
    more are the files read again, with more room."""
    from regscope.sinks import materialize

    if not files_exist_any(spark, paths):
        return None
    if _in_blocks(spark, paths, block_bytes):
        return _cells_in_blocks(spark, paths, block_bytes)
    reader = spark.read.option("header", False).option("multiLine", True).option("escape", '"').option("quote", '"')
    room = len(reader.csv(_paths(paths)).columns) + SPARE_CELLS
    while True:
        names = [f"c{i}" for i in range(room)]
        raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*names, "over"]])).csv(_paths(paths))
        used = F.greatest(F.lit(0), *[F.when(F.col(c).isNotNull(), i + 1) for i, c in enumerate(names)])
        cells = materialize(raw.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("rid"),
                                       F.slice(F.array(*names), F.lit(1), used).alias("cells"), F.col("over").isNotNull().alias("over")), "csv-cells")
        if cells.where("over").isEmpty():
            return cells.drop("over")
        if room >= MAX_CELLS:
            raise ValueError(f"a row has more than {room} cells")
        room = min(MAX_CELLS, room * 4)


def read_csv_union(spark: SparkSession, paths, with_path: bool = False, uniform: bool = False,
                   surplus: str = "raise", position: str | None = None, block_bytes: int | None = None) -> DataFrame | None:
    """S2: files of one table whose headers differ, matched by column *name*.

    Zero-byte files contribute nothing. Columns absent from a file are ``''``
    there. Returns ``None`` when no file has a header. ``uniform=True`` says that
    every file has the same header (one plain read). ``position`` adds a row
    number that ascends in file path order, and in row order within a file; numbers
    may be left out. ``block_bytes`` cuts files into blocks of this size.
    """
    if surplus not in ("raise", "quarantine"):
        raise ValueError("surplus is 'raise' or 'quarantine'")
    if uniform and position is None:
        return read_csv_text(spark, paths, with_path=with_path, surplus=surplus, block_bytes=block_bytes) if files_exist_any(spark, paths) else None
    from regscope.sinks import materialize

    cells = _cells(spark, paths, block_bytes)
    if cells is None:
        return None
    # written: three steps need it, and the planner then knows that it is small
    # beside the rows, which need not be moved to meet it
    per_file = cells.groupBy("file").agg(F.min_by("cells", "rid").alias("header"), F.min("rid").alias("first"), (F.max("rid") - F.min("rid") + 1).alias("rows"))
    per_file = materialize(per_file.coalesce(1) if len(spark.read.text(_paths(paths)).inputFiles()) < FEW_FILES else per_file, "csv-files")
    # a small aggregate: one row per distinct header, not per file
    names = [r["name"] for r in per_file.groupBy("header").agg(F.min("file").alias("file"))
             .select("file", F.posexplode("header").alias("at", "name")).where(F.coalesce("name", F.lit("")) != "")
             .groupBy("name").agg(F.min(F.struct("file", "at")).alias("seen")).orderBy("seen").select("name").collect()]
    if not names:
        return None
    if position is not None:
        # rows of the files before each, in path order
        several = len(spark.read.text(_paths(paths)).inputFiles()) > 1
        per_file = running_sum(ordinals(per_file, ["file"], "__at"), "__at", "rows", "before") if several else per_file.withColumn("before", F.lit(0))
    rows = cells.join(per_file, "file").where(F.col("rid") > F.col("first"))
    over = F.size("cells") > F.size("header")
    rows = rows.where(~over) if surplus == "quarantine" else rows.where(
        F.when(over, F.raise_error(F.concat(F.lit("row wider than its header in "), F.col("file"))).cast("boolean")).otherwise(F.lit(True)))
    columns = [F.coalesce(F.get("cells", F.coalesce(F.array_position("header", n), F.lit(0)).cast("int") - 1), F.lit("")).alias(n) for n in names]
    extra = [F.col("file").alias(PATH_COLUMN)] if with_path else []
    if position is not None:
        extra.append((F.col("before") + F.col("rid") - F.col("first")).cast("bigint").alias(position))
    return rows.select(*columns, *extra)


#: As much of a file as its header may take.
HEADER_BYTES = 64 << 10


def file_headers(spark: SparkSession, paths) -> DataFrame:
    """(path, position, column): the header of each file, from its first bytes alone.
    Files without a header have no rows."""
    files = list_files(spark, paths).where(F.col("length") > 0)
    head = F.decode(F.col("head"), "UTF-8")
    # the first record: what is quoted may hold line breaks
    record = F.regexp_extract(head, r'\A((?:"(?:[^"]|"")*+"|[^"\n])*+)(?:\n|\z)', 1)
    whole = F.when((F.octet_length("head") < HEADER_BYTES) | (F.length(record) < F.length(head)), record).otherwise(
        F.raise_error(F.concat(F.lit(f"a header of more than {HEADER_BYTES} bytes: "), F.col("path"))).cast("string"))
    names = leading_bytes(spark, files, HEADER_BYTES).select("path", F.posexplode(cells_of(F.regexp_replace(whole, "\r\\z", ""))).alias("position", "column"))
    return names.where(F.col("column") != "")


def undeclared_columns(spark: SparkSession, paths, declared) -> DataFrame:
    """K6 before anything is read or written: (path, column) of every column that a file
    has and the table's declared list has not."""
    found = file_headers(spark, paths).select("path", "column")
    return found.where(~F.col("column").isin(*declared))


def read_collection_table(spark: SparkSession, root: str, table: str, with_path: bool = False) -> DataFrame | None:
    """S6: one table's file from every collection folder (``root/<collection>/<table>.csv``)."""
    return read_csv_union(spark, f"{root.rstrip('/')}/*/{table}.csv", with_path=with_path)


def read_partitioned_csv(spark: SparkSession, root: str, key_column: str, strict: bool = True,
                         position: str | None = None) -> DataFrame | None:
    """S3: ``root/<key>/<hex hash>.csv`` files; the directory names ``key_column``
    and the file stem names ``resource``, both taken from the path (Q3).
    ``strict=False`` leaves the rows as written, with the path as ``__path``.
    ``position`` numbers the rows, see ``read_csv_union``."""
    from regscope.plans.consolidate import override_from_path

    df = read_csv_union(spark, f"{root.rstrip('/')}/*/*.csv", with_path=True, position=position)
    if df is None:
        return None
    return override_from_path(df, key_column, PATH_COLUMN).drop(PATH_COLUMN) if strict else df


def read_positioned_csv(spark: SparkSession, path: str, position: str = "pos", block_bytes: int | None = None) -> DataFrame:
    """S1 plus the row's position: file by file in path order, then row by row. For
    lists whose meaning depends on order, e.g. groups separated by blank rows, and
    for tables whose last row wins."""
    df = read_csv_union(spark, path, position=position, block_bytes=block_bytes)
    if df is None:
        raise ValueError(f"no CSV file with a header under {path}")
    return df


def read_blank_delimited_groups(spark: SparkSession, path: str) -> DataFrame:
    """A curated list whose groups are separated by all-blank rows -> rows with
    a ``group_id`` (see ``operators.windows.blank_delimited_groups``)."""
    from regscope.operators.windows import blank_delimited_groups

    df = read_positioned_csv(spark, path)
    return blank_delimited_groups(df, "pos", [c for c in df.columns if c != "pos"])


def snake_case_columns(df: DataFrame) -> DataFrame:
    """kebab-case CSV headers -> snake_case column names (``issue-type`` -> ``issue_type``)."""
    return df.withColumnsRenamed({c: c.replace("-", "_") for c in df.columns if "-" in c})


def files_exist(spark: SparkSession, pattern: str) -> bool:
    """Does ``pattern`` name at least one readable file? (Plan-time check; a
    missing path makes the reader raise during analysis.)"""
    from pyspark.errors import AnalysisException

    try:
        spark.read.text(pattern).schema
        return True
    except AnalysisException as e:  # anything but an absent path is an error of its own
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def files_exist_any(spark: SparkSession, paths) -> bool:
    return any(files_exist(spark, p) for p in _paths(paths))


def sniff_files(spark: SparkSession, pattern: str) -> DataFrame:
    """P18 over landed files: (path, filetype) from each file's leading bytes, which tasks
    read by themselves (``sources.ranged``): a file's size does not matter."""
    from regscope.functions.sniff import LEADING_BYTES, filetype_of_bytes

    heads = leading_bytes(spark, list_files(spark, pattern), LEADING_BYTES)
    return heads.select("path", filetype_of_bytes("head").alias("filetype"))

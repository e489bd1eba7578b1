"""Quoted CSV cut into records in parallel: a file is as many tasks as it has blocks.

A quoted cell may hold line breaks, so whether a line ends a record depends on all
text before it. But a line can do only four things to the state "inside a quoted cell
or not": leave it, turn it round, end outside in any case, end inside in any case.
Such functions compose, so the state at each block's start follows from one function
per block:

1. Spark's text source reads physical lines by byte ranges (blocks). Each line's
   function is found by itself, only where it has a quote at all.
2. The lines' functions are composed per block, and the blocks' along their file, a
   prefix scan over one row per block.
3. A block that begins outside and has no line that changes the state is whole as it
   is: each line is a record. In other blocks lines learn the state before them, in
   a window of one block. Only the lines of records that span lines meet in a group.

Lines end at ``\\n``; a ``\\r`` before it is dropped at a record's end and kept inside
a quoted cell. A quote opens a cell only at its start (``5" pipe`` is text), and ``""``
is a quote, as in Python's ``csv``. Empty lines between records are no records. A
record above ``MAX_RECORD`` bytes is an error: a quote was never closed.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regscope.sources.ranged import list_files

#: Bytes of small blocks that one task reads.
TASK_BYTES = 32 << 20
#: Longest record (bytes); beyond it a quote is taken not to be closed.
MAX_RECORD = 16 << 20

_INSIDE = r'(?:[^"]|"")*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+)'
_OPENS = rf'\A(?:{_FIELD},)*+"{_INSIDE}\z'
_STAYS = rf'\A{_INSIDE}\z'
_REOPENS = rf'\A{_INSIDE}"[^,]*+(?:,{_FIELD})*+,"{_INSIDE}\z'


@contextmanager
def _blocks_of(spark: SparkSession, block_bytes: int | None):
    """While a read is planned and run: blocks of this size (None: the session's)."""
    if block_bytes is None:
        yield
        return
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, str(block_bytes))
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _after(line: Column) -> tuple[Column, Column]:
    """Is a line's end inside a quoted cell, if it begins outside; if it begins inside?"""
    quoted = F.contains(line, F.lit('"'))
    outside = quoted & line.rlike(_OPENS)
    inside = ~quoted | line.rlike(_STAYS) | line.rlike(_REOPENS)
    return outside, inside


def read_lines(spark: SparkSession, paths, block_bytes: int | None = None) -> DataFrame:
    """(file, block, pos, line, outside, inside): physical lines, written once to the
    shared folder, so that every later step sees the same blocks."""
    from regscope.sinks import materialize

    paths = [paths] if isinstance(paths, str) else list(paths)
    size = list_files(spark, paths).agg(F.sum("length")).first()[0] or 0
    with _blocks_of(spark, block_bytes):
        raw = spark.read.text(paths, lineSep="\n").select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
        # positions are those of the blocks; a task takes many small blocks, one after the other
        if block_bytes is not None:
            raw = raw.coalesce(max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))
        outside, inside = _after(F.col("line"))
        return materialize(raw.select("*", outside.alias("outside"), inside.alias("inside")), "csv-lines")


def _state(rows: DataFrame, by: list[str], order: str, start: Column) -> DataFrame:
    """``after`` (boolean): the state after each row, in order, of functions ``outside``
    and ``inside``; ``start`` is the state before the first. A function that ends alike
    in any case settles the state; after the last such row only turns count. All windows
    have one order, so rows are sorted once."""
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.col("outside") == F.col("inside")
    turn = F.col("outside") & ~F.col("inside")
    rows = rows.withColumn("__turns", F.sum(F.when(turn, 1).otherwise(0)).over(upto))
    rows = rows.withColumn("__last", F.last(F.when(fixed, F.struct(F.col("outside").alias("state"), F.col("__turns").alias("turns"))), ignorenulls=True).over(upto))
    turned = (F.col("__turns") - F.coalesce("__last.turns", F.lit(0))) % 2 == 1
    return rows.withColumn("after", F.coalesce("__last.state", start) != turned).drop("__turns", "__last")


def _functions(lines: DataFrame) -> DataFrame:
    """(file, block, first, marks, outside, inside): each block's first position, how many
    lines may change the state, and what all its lines together do to it: where the last
    line that settles the state is, and how often it turns after that. Aggregates of
    numbers only: nothing is sorted, and a block is one row before any shuffle."""
    from regscope.sinks import materialize

    settles, turns = F.col("outside") == F.col("inside"), F.col("outside") & ~F.col("inside")
    blocks = materialize(lines.groupBy("file", "block").agg(
        F.min("pos").alias("first"), F.sum(F.when(F.col("outside") | ~F.col("inside"), 1).otherwise(0)).alias("marks"),
        F.max(F.when(settles & F.col("outside"), F.col("pos"))).alias("in_at"), F.max(F.when(settles & ~F.col("outside"), F.col("pos"))).alias("out_at")), "csv-marks")
    settled = F.greatest("in_at", "out_at")  # of NULL and a number, the number
    odd = lines.where(turns).select("file", "block", "pos").join(blocks.select("file", "block", settled.alias("at")), ["file", "block"]).where(
        F.col("at").isNull() | (F.col("pos") > F.col("at"))).groupBy("file", "block").agg((F.count(F.lit(1)) % 2 == 1).alias("odd"))
    every = blocks.join(odd, ["file", "block"], "left")
    turned = F.coalesce("odd", F.lit(False))
    state = F.coalesce(F.col("in_at") == settled, F.when(settled.isNotNull(), False))  # NULL: nothing settles it
    return every.select("file", "block", "first", "marks", (F.coalesce(state, F.lit(False)) != turned).alias("outside"),
                        (F.coalesce(state, F.lit(True)) != turned).alias("inside"))


def _trimmed(record: Column) -> Column:
    return F.regexp_replace(record, "\r\\z", "")


def read_records(spark: SparkSession, paths, block_bytes: int | None = None) -> DataFrame:
    """(file, block, n, record): a file's records in the order of (block, n); ``block``
    and ``n`` are where a record begins. Blank records are left out, their ``n`` too."""
    from regscope.sinks import materialize

    lines = read_lines(spark, paths, block_bytes)
    # one row per block, written: several steps need it
    along = Window.partitionBy("file").orderBy("block")
    states = _state(_functions(lines), ["file"], "block", F.lit(False))
    blocks = materialize(states.select("file", "block", "first", "marks", F.coalesce(F.lag("after").over(along), F.lit(False)).alias("open")), "csv-blocks")
    plain = blocks.where(~F.col("open") & (F.col("marks") == 0)).select("file", "block", "first")
    simple = lines.join(plain, ["file", "block"]).select("file", "block", (F.col("pos") - F.col("first")).alias("n"), F.col("line").alias("record"))
    if blocks.where(F.col("open") | (F.col("marks") > 0)).isEmpty():
        return _kept(simple)
    mixed = lines.join(blocks.where(F.col("open") | (F.col("marks") > 0)).select("file", "block", "open"), ["file", "block"])
    inside = Window.partitionBy("file", "block").orderBy("pos")
    mixed = _state(mixed, ["file", "block"], "pos", F.col("open"))
    mixed = mixed.withColumn("begins", ~F.coalesce(F.lag("after").over(inside), F.col("open")))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mixed = mixed.withColumn("n", F.sum(F.when(F.col("begins"), 1).otherwise(0)).over(upto) - 1)
    mixed = materialize(mixed.select("file", "block", "pos", "line", "begins", "after", "n"), "csv-mixed")
    single = mixed.where(F.col("begins") & ~F.col("after")).select("file", "block", "n", F.col("line").alias("record"))
    # where lines that a block inherits belong: the last record begun in an earlier block
    begun = mixed.groupBy("file", "block").agg(F.max(F.when(F.col("begins"), F.struct("block", "n"))).alias("last"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = begun.select(F.col("file").alias("__f"), F.col("block").alias("__b"), F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    parts = mixed.where(~(F.col("begins") & ~F.col("after")))
    parts = parts.join(carried, (F.col("file") == F.col("__f")) & (F.col("block") == F.col("__b")))
    at = F.when(F.col("n") >= 0, F.struct("block", "n")).otherwise(F.col("carried"))
    parts = parts.select("file", at.alias("at"), "block", "pos", "line")
    long = parts.groupBy("file", "at").agg(F.sum(F.octet_length("line") + 1).alias("size")).where(F.col("size") > MAX_RECORD)
    found = long.select("file").take(1)
    if found:
        raise ValueError(f"a record of more than {MAX_RECORD} bytes in {found[0]['file']}: is a quote not closed?")
    pieces = F.array_sort(F.collect_list(F.struct("block", "pos", "line")))
    spanning = parts.groupBy("file", "at").agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("record")).select(
        "file", F.col("at.block").alias("block"), F.col("at.n").alias("n"), "record")
    return _kept(simple.unionByName(single).unionByName(spanning))


def _kept(records: DataFrame) -> DataFrame:
    return records.select("file", "block", F.col("n").cast("bigint").alias("n"), _trimmed(F.col("record")).alias("record")).where("record <> ''")


def cells(record: Column) -> Column:
    """A record's cells: quotes around a cell go, doubled ones inside become one."""
    every = F.regexp_extract_all(F.concat(record, F.lit(",")), F.lit(rf'("{_INSIDE}"[^,]*+|[^,]*+),'), F.lit(1))
    quoted = rf'(?s)\A"({_INSIDE})"(.*)\z'
    return F.transform(every, lambda c: F.when(c.startswith('"'), F.concat(
        F.replace(F.regexp_extract(c, quoted, 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, quoted, 2))).otherwise(c))

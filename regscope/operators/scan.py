"""Running totals in a given order, without one task that sees every row.

``running_sum`` is a blocked prefix sum of any depth: rows are cut by position into
blocks of at most ``width`` positions; a window adds up within each block, and the
blocks' totals, one row each, are summed the same way, level by level, until one
block is left. ``ordinals`` numbers rows in the order of any columns: a range
partitioned sort, whose partitions' row counts get the same prefix sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window task sorts, at most.
WIDTH = 1 << 20
_IN_PARTITION = (1 << 33) - 1


def running_sum(df: DataFrame, position: str, value: str, out: str, width: int = WIDTH, inclusive: bool = False) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over rows of lower ``position`` (and, if
    ``inclusive``, of the row itself). Positions are integers from 0, unique among
    rows; gaps do no harm. NULL values count as 0."""
    top = df.agg(F.max(position)).first()[0]
    return _level(df, position, value, out, width, 0 if top is None else int(top), inclusive)


def _level(df: DataFrame, position: str, value: str, out: str, width: int, top: int, inclusive: bool) -> DataFrame:
    block = F.floor(F.col(position) / F.lit(width)).cast("bigint")
    end = 0 if inclusive else -1
    within = Window.partitionBy("__block").orderBy(position).rowsBetween(Window.unboundedPreceding, end)
    rows = df.withColumn("__block", block)
    rows = rows.withColumn("__own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    if top < width:  # one block holds all
        return rows.withColumn(out, F.col("__own").cast("bigint")).select(*df.columns, out)
    totals = df.groupBy(block.alias("__at")).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__total"))
    # blocks of one position each are as many as the positions: only wider ones get fewer
    before = _level(totals, "__at", "__total", "__before", max(width, 2), top // width, False)
    rows = rows.join(before.select(F.col("__at").alias("__block"), "__before"), "__block")
    return rows.withColumn(out, (F.col("__before") + F.col("__own")).cast("bigint")).select(*df.columns, out)


def ordinals(df: DataFrame, order: Sequence, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` plus ``out``: 0 for the first row in the given order, 1 for the next, and so on.
    The sorted rows are written to the shared folder, so that a number never changes."""
    from regscope.sinks import materialize

    ranked = df.orderBy(*order).select("*", F.spark_partition_id().cast("bigint").alias("__part"),
                                       F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("__own"))
    rows = materialize(ranked, "ordinals")
    parts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = running_sum(parts, "__part", "__n", "__before", width).select("__part", "__before")
    return rows.join(before, "__part").withColumn(out, F.col("__before") + F.col("__own")).select(*df.columns, out)

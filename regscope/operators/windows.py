"""Order-dependent operators: repeated keys within a file and blank-row
delimited groups.

Neither gathers a whole group (or the whole table) into one task:

* ``repeated_rows`` finds the first position of each key that occurs more than
  once with a partial aggregate; only those keys, few as a rule, meet the rows
  again, in a semi join (one row per key on that side: Spark splits the other
  side of a key that very many rows have).
* ``blank_delimited_groups`` is a running count of blank rows in position
  order, a blocked prefix sum of any depth (``operators.scan``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regscope.operators.scan import WIDTH, running_sum


def repeated_rows(df: DataFrame, file_keys: Sequence[str], row_keys: Sequence[str], position: str) -> DataFrame:
    """Rows whose ``row_keys`` already occurred earlier (lower ``position``) in
    the same file (``file_keys``). Positions are unique within a file."""
    keys = list(file_keys) + list(row_keys)
    first = (df.groupBy(*keys).agg(F.min(position).alias("__first"), F.count(F.lit(1)).alias("__n"))
             .where(F.col("__n") > 1).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__first"))
    cond = F.col(f"`{position}`") > F.col("__first")
    for i, k in enumerate(keys):
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
    return df.join(first, cond, "left_semi")


def blank_delimited_groups(df: DataFrame, position: str, columns: Sequence[str],
                           bucket_width: int = WIDTH) -> DataFrame:
    """Number the groups of a list separated by all-blank rows.

    ``group_id`` = number of blank rows before the row (so consecutive blank
    rows leave an unused number); blank rows themselves are dropped.
    ``position`` is an integer file position, unique per row.
    """
    blank = None
    for c in columns:
        b = F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
        blank = b if blank is None else (blank & b)
    marked = df.withColumn("__blank", blank.cast("long"))
    out = running_sum(marked, position, "__blank", "group_id", bucket_width)
    return out.where(F.col("__blank") == 0).select(*df.columns, "group_id")

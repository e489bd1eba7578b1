"""Aggregation operators.

All of them are expressed as ``groupBy().agg()`` with built-in aggregate
functions, so Spark runs them with a map-side partial aggregation: a key that
holds a third of the rows is reduced inside every input task before the
shuffle, and no group is ever gathered whole into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOP = "__top"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def top_by(df: DataFrame, keys, order: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """Arg-max per key: the row whose ``order`` tuple is greatest.

    ``order`` is compared left to right, each column descending with NULLs
    last (a NULL field is the smallest value); list enough columns to make the
    order total so the pick is deterministic. ``payload`` columns are taken from
    the same row. Implemented as ``max(struct(order..., payload...))`` — a
    partial aggregate, unlike ``row_number()`` over a window which would sort
    every key's rows inside one task.
    """
    keys = _names(keys)
    fields = list(order) + [c for c in payload if c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in fields])).alias(_TOP))
    return picked.select(*keys, *[F.col(f"{_TOP}.{c}").alias(c) for c in fields])


def distinct_list(c, sep: str = ";") -> Column:
    """Sorted distinct non-NULL values joined by ``sep``; NULL when there are none.

    The set per group is bounded by the number of distinct values (partial
    aggregation de-duplicates map-side), never by the row count.
    """
    c = F.col(c) if isinstance(c, str) else c
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 0, F.array_join(s, sep))


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """pandas ``groupby`` semantics: rows with a NULL in any key form no group."""
    cond = None
    for k in _names(keys):
        c = F.col(k).isNotNull()
        cond = c if cond is None else (cond & c)
    return df.where(cond)


def inverted_index(df: DataFrame, key: str, value: str, sep: str = ";") -> DataFrame:
    """key -> sorted distinct values (as ``sep``-joined text) and their count."""
    return df.groupBy(key).agg(
        distinct_list(value, sep).alias(f"{value}s"),
        # the same set, counted: no distinct aggregation beside it
        F.size(F.collect_set(F.col(value))).cast("bigint").alias(f"{value}_count"),
    )

"""Join operators.

Join strategy is left to Catalyst + AQE: a side whose size the planner can
bound (file statistics at plan time, shuffle statistics at run time under AQE)
below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, anything larger
becomes a sort-merge join whose skewed partitions AQE splits. No explicit
``broadcast()`` is written: frames built from fixed literal lists are local
relations whose exact size the planner already knows. Sides that grow with the
registry but whose file statistics are far too small (texts made of numbers,
exploded rows) are joined with a ``merge`` hint, so that no driver holds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_left_join(left: DataFrame, right: DataFrame,
                        pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """pandas ``merge(how='left', left_on, right_on)``: NULL keys match NULL keys.

    Right key columns whose name equals the left key are dropped (pandas keeps
    one column for a shared key name); differently named right keys stay.
    """
    shared = {rc for lc, rc in pairs if lc == rc}
    clash = (set(left.columns) & set(right.columns)) - shared
    if clash:
        raise ValueError(f"columns on both sides that are not shared keys: {sorted(clash)}")
    keys = [F.col(rc).alias(f"__rk{i}") for i, (_, rc) in enumerate(pairs)]
    r = right.select(*keys, *[c for c in right.columns if c not in shared])
    cond = None
    for i, (lc, _) in enumerate(pairs):
        c = left[lc].eqNullSafe(r[f"__rk{i}"])
        cond = c if cond is None else (cond & c)
    out = left.columns + [c for c in right.columns if c not in shared]
    return left.join(r, cond, "left").select(*[left[c] if c in left.columns else r[c] for c in out])


def anti_join(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key is not listed in ``other`` (NOT IN without NULL traps)."""
    keys = other.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull())
    return df.join(keys, df[left_key] == keys["__k"], "left_anti")


def null_safe_semi_join(df: DataFrame, keys: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` whose key matches a key of ``keys`` (NULL matches NULL).

    Used to restrict a large fact aggregate to the keys a later left join can
    actually match; when the join columns are grouping columns of an aggregate
    below, Catalyst pushes the semi join beneath it, so fewer rows are aggregated.
    """
    k = keys.select(*[F.col(rc).alias(f"__sk{i}") for i, (_, rc) in enumerate(pairs)]).distinct()
    cond = None
    for i, (lc, _) in enumerate(pairs):
        c = df[lc].eqNullSafe(k[f"__sk{i}"])
        cond = c if cond is None else (cond & c)
    return df.join(k, cond, "left_semi")

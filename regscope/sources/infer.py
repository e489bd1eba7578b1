"""Column types of text tables, as one aggregate.

Each type has a bit. A value has the bits of all types that it can be read as, and a
column has the bits that all its values share (``bit_and``, which is partial: each
task keeps one number a column). The narrowest of these is the column's type. Blank
cells say nothing; a column of blanks is text. Because the bits of a wider type come
with those of a narrower one, integers among decimals give decimals, and anything
among anything else gives text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: From narrow to wide: type, what its text looks like (a cast must succeed as well).
LATTICE: list[tuple[T.DataType, str]] = [
    (T.BooleanType(), r"\A(?i:true|false)\z"),
    (T.IntegerType(), r"\A[+-]?[0-9]{1,10}\z"),
    (T.LongType(), r"\A[+-]?[0-9]{1,19}\z"),
    (T.DoubleType(), r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"),
    (T.DateType(), r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"),
    (T.TimestampType(), r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"),
]
_TEXT = 1 << len(LATTICE)


def readable_as(value: Column) -> Column:
    """The bits of the types that a text can be read as; NULL for a blank."""
    bits = F.lit(_TEXT)
    for i, (kind, looks) in enumerate(LATTICE):
        fits = value.rlike(looks) & value.try_cast(kind).isNotNull()
        bits = bits + F.when(fits, 1 << i).otherwise(0)
    return F.when(value != "", bits)


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, T.DataType]:
    """Each text column's narrowest type, from one aggregate over ``df``."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)] if columns is None else list(columns)
    if not names:
        return {}
    row = df.agg(*[F.bit_and(readable_as(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(names)]).first()
    found = {}
    for i, c in enumerate(names):
        bits = row[f"c{i}"]
        found[c] = next((kind for j, (kind, _) in enumerate(LATTICE) if bits is not None and bits >> j & 1), T.StringType())
    return found


def typed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``df`` with its text columns read as ``types``; a blank is NULL."""
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])

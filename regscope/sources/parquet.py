"""Parquet sources: one table per file, and the union of files whose schemas drift."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regscope.operators.setops import union_by_name, widened
from regscope.sources.ranged import list_files, parquet_footers

#: Where Spark keeps a file's schema as it was written.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, schema as JSON) of each footer."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    for b in batches:
        found = []
        for footer in b.column("footer").to_pylist():
            own = pq.read_metadata(pa.BufferReader(footer))
            written = (own.metadata or {}).get(_SPARK_SCHEMA)
            found.append(written.decode() if written else from_arrow_schema(own.schema.to_arrow_schema().remove_metadata()).json())
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(found, pa.string())], ["path", "schema"])


def file_schemas(spark: SparkSession, paths) -> DataFrame:
    """(path, schema): the schema of every Parquet file below ``paths``, as JSON, from
    footers that tasks read by themselves: neither a driver loop nor file content."""
    files = list_files(spark, paths, "*.parquet", recursive=True)
    return parquet_footers(spark, files).mapInArrow(_schemas, "path string, schema string")


def _readable_as(own: T.DataType, wide: T.DataType) -> bool:
    """Does Spark's Parquet reader widen ``own`` to ``wide`` while it reads?"""
    integers = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if own == wide:
        return True
    if isinstance(own, integers) and isinstance(wide, integers):
        return True
    if isinstance(own, (T.ByteType, T.ShortType, T.IntegerType)) and isinstance(wide, T.DoubleType):
        return True
    if isinstance(own, T.FloatType) and isinstance(wide, T.DoubleType):
        return True
    if isinstance(own, T.DateType) and isinstance(wide, T.TimestampNTZType):
        return True
    if isinstance(own, T.DecimalType) and isinstance(wide, T.DecimalType):
        return wide.scale >= own.scale and wide.precision - wide.scale >= own.precision - own.scale
    return False


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def read_parquet_union(spark: SparkSession, paths) -> DataFrame:
    """S4: union by column name of Parquet files whose schemas differ; a column
    missing from a file is NULL there, and types are widened (``setops.widened``).

    Footers are read in a Spark job (``file_schemas``), and only the distinct schemas,
    in the order in which they first occur by path, reach the driver. Spark's reader widens
    integers, floats, decimals and dates itself, so that one scan of all files under the
    wide schema will do; only files with a type that must be cast (text for a number,
    say) are read by schema, and united.
    """
    from regscope.sinks import materialize

    paths = [paths] if isinstance(paths, str) else list(paths)
    # a folder's own partition columns (``key=value``) are Spark's to find
    schemas = materialize(file_schemas(spark, paths), "parquet-schemas")
    distinct = schemas.groupBy("schema").agg(F.min("path").alias("first")).orderBy("first").collect()
    if not distinct:
        raise FileNotFoundError(f"no Parquet file under {paths}")
    own = [T.StructType.fromJson(json.loads(r["schema"])) for r in distinct]
    wide = widened(own)
    keyed = not schemas.where(F.col("path").rlike("/[^/=]+=[^/]*/")).isEmpty()
    reader = spark.read if keyed else spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    types = {f.name: f.dataType for f in wide.fields}
    if all(_readable_as(f.dataType, types[f.name]) for s in own for f in s.fields):
        return reader.schema(_nullable(wide)).parquet(*paths)
    # a scan takes a list of paths: one row per file reaches the driver in this case alone
    groups: dict[str, list[str]] = defaultdict(list)
    for r in schemas.orderBy("path").collect():
        groups[r["schema"]].append(r["path"])
    frames = [spark.read.schema(_nullable(T.StructType.fromJson(json.loads(r["schema"])))).parquet(*groups[r["schema"]]) for r in distinct]
    return union_by_name(frames)

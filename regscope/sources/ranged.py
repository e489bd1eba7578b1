"""Parts of files, read where the tasks run: a file's first bytes, or its last.

Spark lists the files (path and length; no content). Tasks open each path and read
the range asked for, through Arrow's file systems, so a store must be one that Arrow
can open (local and mounted folders, HDFS, S3, Google and Azure storage). For any
other, Spark's ``binaryFile`` source reads files whole, and cuts the range from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# URI schemes that Arrow opens, and the names it knows them by.
ARROW_SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
                 "abfs": "abfs", "abfss": "abfss"}
#: Files whose paths one task of a listing holds.
FILES_A_TASK = 500


def list_files(spark: SparkSession, paths, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, length) of every file that is not empty; content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load([paths] if isinstance(paths, str) else list(paths))
    return files.select("path", "length")


def _opener():
    """uri -> open random-access file; file systems are kept for the task."""
    from pyarrow import fs

    held: dict = {}

    def open_file(uri: str):
        parts = urlsplit(uri) if "://" in uri or uri.startswith("file:") else None
        scheme = ARROW_SCHEMES[parts.scheme if parts else ""]
        if scheme == "file":
            path = uri.split(":", 1)[1] if parts else uri
            path = "/" + path.lstrip("/")
            system = held.setdefault("file", fs.LocalFileSystem())
        else:
            key = (scheme, parts.netloc)
            if key not in held:
                held[key] = fs.FileSystem.from_uri(f"{scheme}://{parts.netloc}/")[0]
            system = held[key]
            path = uri.split("://", 1)[1] if scheme in ("s3", "gs") else uri.split("://", 1)[1].split("/", 1)[1]
            if scheme in ("hdfs", "viewfs"):
                path = "/" + path
        return system.open_input_file(path)

    return open_file


def read_ranges(spark: SparkSession, files: DataFrame, read, schema: str, whole) -> DataFrame:
    """Rows that ``read(path, length, open_file)`` makes of each file of ``files``
    (path, length). ``whole`` is a column of the same type made of a file's bytes
    (``content``): the way for stores that Arrow cannot open."""
    schemes = [r["scheme"] for r in files.select(F.regexp_extract("path", "^([a-zA-Z0-9]+):", 1).alias("scheme")).distinct().collect()]
    name = schema.split()[0]
    if not set(schemes) <= set(ARROW_SCHEMES):
        content = spark.read.format("binaryFile").load([r["path"] for r in files.select("path").collect()])
        return content.select("path", whole.alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file = _opener()
        for b in batches:
            found = [read(p, n, open_file) for p, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["path", name])

    return files.select("path", "length").mapInArrow(run, f"path string, {schema}")


def leading_bytes(spark: SparkSession, files: DataFrame, n: int) -> DataFrame:
    """(path, head): the first ``n`` bytes of each file, or all of a shorter one."""
    def read(path: str, length: int, open_file) -> bytes:
        with open_file(path) as f:
            return f.read_at(min(n, length), 0)

    return read_ranges(spark, files, read, "head binary", F.substring("content", 1, n))


def parquet_footers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, footer): the bytes of each Parquet file from its footer on."""
    def read(path: str, length: int, open_file) -> bytes:
        with open_file(path) as f:
            end = f.read_at(min(8, length), max(0, length - 8))
            if len(end) < 8 or end[4:] != b"PAR1":
                raise ValueError(f"not a Parquet file: {path}")
            size = min(length, int.from_bytes(end[:4], "little") + 8)
            return f.read_at(size, length - size)

    little = F.hex(F.expr("substring(content, -8, 4)"))
    size = F.conv(F.concat(*[F.substring(little, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("int") + 8
    return read_ranges(spark, files, read, "footer binary", F.expr("content").substr(-size, size))

"""Incremental consolidation of landed partition files.

The reference only fetches files that have not landed yet and appends new
issue rows to the existing consolidated issue table. On Spark the natural
form of "process each landed file once, append its rows" is a Structured
Streaming file source with a checkpoint: the source's file log records which
files were consumed, so each run (``trigger(availableNow=True)``, i.e. a
batch-like incremental run) reads only the files that arrived since the last
one, and a failed run resumes from the checkpoint without duplicating rows.

Rows keep the reference's path semantics: the directory names the
pipeline/dataset and the file stem the resource (both override the row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regscope.plans.consolidate import override_from_path


def landed_csv_stream(spark: SparkSession, input_dir: str, fields: Sequence[str], key_column: str) -> DataFrame:
    """Streaming DataFrame over ``input_dir/<key>/<hash>.csv`` files (all text
    columns ``fields``; blanks are ``''``), with path keys applied.

    A streaming source has one schema, so landed files must carry the header
    ``fields`` (as one pipeline tool writes them); ``enforceSchema=false`` makes
    Spark reject a file with another header instead of assigning columns by
    position. Files with differing headers go through the batch passes
    (``plans.build.concat_issues``), which match columns by name."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    raw = (spark.readStream.schema(schema).option("header", True).option("multiLine", True)
           .option("escape", '"').option("enforceSchema", False)
           .csv(f"{input_dir.rstrip('/')}/*/*.csv")
           .select("*", F.col("_metadata.file_path").alias("__path")))
    filled = raw.fillna("", subset=list(fields))
    return override_from_path(filled, key_column, "__path").drop("__path")


def append_landed(spark: SparkSession, input_dir: str, out_dir: str, fields: Sequence[str],
                  key_column: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append the rows of every file landed since the previous run to the
    Parquet table at ``out_dir`` and stop when caught up.

    The checkpoint belongs to the table: it lies beside it unless given, so any
    later run, in any process, goes on where the last one stopped.
    """
    if checkpoint is None:
        checkpoint = f"{out_dir.rstrip('/')}.checkpoint"
    stream = landed_csv_stream(spark, input_dir, fields, key_column)
    return (stream.writeStream.format("parquet").option("path", out_dir)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start())

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: ASCII blanks; every operator splits words on these alone.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only a local
    session without that setting gets a scratch folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = os.path.join(tempfile.gettempdir(), f"llm-{spark.sparkContext.applicationId}")
    return f"file://{path}"


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut at a
    table that survives the loss of any executor."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def batch_plan(total_bytes: int, unit: int = 4 << 20) -> tuple[int, int]:
    """(number of batches, number of key ranges) for a two-way exchange between
    batches of documents and ranges of hashed keys. A batch holds ``unit`` bytes
    of text, and grows with the square root of the input beyond, so that batches
    times ranges (the messages of the exchange) grow with the input only."""
    batch = max(unit, int(8 * math.sqrt(max(total_bytes, 1))))
    n = max(1, -(-total_bytes // batch))
    return n, n


def with_batch(docs: DataFrame, n: int, columns: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``pid`` (0 to n-1) and the given columns. Id and text together decide: neither
    an id (or null) nor a text that very many rows have makes a batch large."""
    return docs.select(F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)), F.lit(n)).cast("int").alias("pid"), *columns)


def row_id(id_col: str = "doc_id", text: Column | str = "text") -> Column:
    """A row's id and a hash of its text, as one key without nulls."""
    return F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.xxhash64(text).cast("string"))


def keep_rows(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is among ``kept``'s distinct ``__llm_row``
    values, one for each; all columns stay as they are."""
    return docs.withColumn("__llm_row", key).join(kept, "__llm_row", "left_semi").dropDuplicates(["__llm_row"]).drop("__llm_row")

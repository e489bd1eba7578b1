"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes all rows that its predecessor kept and calls one operator of
``regscope.llm``. All stages but the last return the columns of ``documents``;
the last returns pieces of sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.llm import exact_dedup, mixing, packing, simhash, toxicity
from regscope.llm.common import BLANKS, keep_rows, read_table, row_id, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at or above the threshold go."""
    labels = read_table(spark, sf_dir, "labels").filter(toxicity.training_fold())
    model = toxicity.train(spark, docs, labels)
    return toxicity.score(spark, docs, model, "__llm_toxic").filter(F.col("__llm_toxic") < toxicity.THRESHOLD).drop("__llm_toxic")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for blanks) the row of smallest id stays."""
    found = exact_dedup.exact_dedup(spark, exact_dedup.split_batches(docs))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_sha256")
    kept = found.filter("kept").select(key.alias("__llm_row"))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "), 256)
    return keep_rows(docs, kept, F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), sha))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row of smallest id stays."""
    found = simhash.near_duplicates(spark, docs)
    return keep_rows(docs, simhash.representatives(found), row_id())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages hash and learn in ways SQL cannot express; tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(spark, docs, name)
    return docs

"""The corpus queries: each applies one operator to its whole table, with the
parameters a production run would use, and returns the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regscope.llm import bytecnn, chat, divergence, exact_dedup, fim, mixing, packing, quality, sharding, simhash, substring, suffix, toxicity
from regscope.llm.common import read_table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(read_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(spark, exact_dedup.split_batches(docs))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(spark, read_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(spark, read_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, read_table(spark, sf_dir, "conversations"))
    return chat.digest(chat.format_conversations(rows))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = divergence.divergence(spark, read_table(spark, sf_dir, "documents"))
    return found.select("lang", "source", "part", "item", "value", "rank")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.quality(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_chat_format": op10_chat_format,
    "op11_source_divergence": op11_source_divergence,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_fill_in_middle": op13_fill_in_middle,
}

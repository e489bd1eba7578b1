"""Quality rules: per-document counts, and lines that recur across a host.

A line's normal form has A-Z lower-cased and blanks collapsed; lines without a
word do not count. For each host, a line's frequency is the number of distinct
documents that have it; documents of equal text are one document here, so that
copies do not make a text boilerplate (deduplication deals with them). A line in more
than ``max_docs`` of them is boilerplate; what else its host holds, and how much, does
not matter. Boilerplate lines are removed; a document left with fewer than
``min_words`` words or less than ``min_left`` of its words is depleted, and
rejected. The base rules reject short and repetitive documents before that.

Lines and texts are told apart by 128 bits of hash: chance matches are not to be
expected at any number of lines.

Null text has no words, and fails the base rules. Null is a host. Repeated rows
are rows; an empty table gives an empty result. Columns other than id, text and
host are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.llm.common import stage
from regscope.llm.words import chunks, fresh, hashes, rolling, texts

# Fixed values of the contract's base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Limits of the line rule.
MAX_DOCS = 20
MIN_LEFT = 0.5

_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCHEMA = f"doc_id long, host string, {_BASE}, text_hash binary, lines array<struct<h: binary, n: int>>"
_LINES = pa.list_(pa.struct([("h", pa.binary()), ("n", pa.int32())]))
_KEEP_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)


def repeat_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Of each document, the words that lie in a window of ``window`` words found
    twice or more in it."""
    counts = np.array([len(w) for w in words], np.int64)
    total = int(counts.sum())
    out = np.zeros(len(words), np.int64)
    if total < window:
        return out
    doc = np.repeat(np.arange(len(words)), counts)
    win = rolling(hashes([x for w in words for x in w]), window)
    inside = np.flatnonzero(doc[:len(win)] == doc[window - 1:])
    with np.errstate(over="ignore"):  # windows of other documents are other windows
        key = win[inside] ^ (doc[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    again = inside[order[same[1:] | same[:-1]]]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    return np.bincount(doc, weights=np.cumsum(cover[:-1]) > 0, minlength=len(words)).astype(np.int64)


def _lines(text: bytes) -> tuple[int, list[dict[str, bytes | int]]]:
    seen: set[bytes] = set()
    dups, held = 0, {}
    for line in text.split(b"\n"):
        words = line.lower().split()
        if not words:
            continue
        if line in seen:
            dups += 1
        else:
            seen.add(line)
        key = b" ".join(words)
        held[key] = held.get(key, 0) + len(words)
    return dups, [{"h": xxhash.xxh3_128_digest(k), "n": n} for k, n in held.items()]


def measure(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the base counts, and its normalised lines, each once,
    with the number of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for b in batches:
            held = texts(b.column("text"))
            for i, j in chunks(map(len, held)):
                part = held[i:j]
                words = [t.split() for t in part]
                lines = [_lines(t) for t in part]
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(i, j - i), b.column("host").slice(i, j - i),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([len(b"".join(w).translate(None, bytes(range(0x80, 0xC0)))) for w in words], pa.int64()),
                    pa.array([len(t.translate(None, _KEEP_SYMBOLS)) for t in part], pa.int64()),
                    pa.array([d for d, _ in lines], pa.int64()),
                    pa.array(repeat_words(words)),
                    pa.array([xxhash.xxh3_128_digest(t) for t in part], pa.binary()),
                    pa.array([x for _, x in lines], _LINES),
                ], names)

    names = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_hash", "lines"]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def boilerplate(measured: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h, n_docs) of the lines above the limit."""
    copies = measured.groupBy("host", "text_hash").agg(F.min("uid").alias("uid"))
    one = measured.select("uid", "host", "lines").join(copies.select("uid"), "uid", "left_semi")
    return one.select("host", F.explode("lines.h").alias("h")).groupBy("host", "h").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > max_docs)


def quality_rules(spark: SparkSession, docs: DataFrame, max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS,
                  min_left: float = MIN_LEFT, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, removed_words, kept."""
    measured = stage(spark, measure(docs, host_col, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "lines")
    bad = stage(spark, boilerplate(measured, max_docs), "boilerplate")
    bad = bad.select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    lines = measured.select("uid", "host", F.inline("lines"))
    removed = lines.join(bad, F.expr("h = _h and host <=> _host")).groupBy("uid").agg(F.sum("n").alias("removed_words"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    return measured.drop("lines").join(removed, "uid", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (left >= min_words) & (left >= min_left * F.col("n_words"))).alias("kept"), "removed_words")

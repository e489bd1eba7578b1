"""Exact deduplication of a stream of batches against immutable snapshots.

A batch that has been worked off is a snapshot: a folder with its rows, the texts that
were new in it (exact rows), and static binary-fuse filters of their digests, one per
bucket. All of it is written once and never changed; later batches, of this run or
of another (``earlier``), read it. A new batch is first grouped by itself, then its
distinct digests are screened by each snapshot's filters; the few that pass are joined
with the exact rows and compared by bytes. The first kept row of a text (smallest id of
the earliest batch) stays for ever.

Texts are equal when they are the same after each run of ASCII blanks is
replaced by one space. Null text counts as empty. Rows of null id rank last in
their group and get the group's ``keep_id`` like any other; of rows that repeat
both id and text, one is kept. An empty table gives an empty result. Other columns
of the input are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.llm.common import BLANKS, shared_dir, stage
from regscope.llm.words import fresh

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Digests in one filter; a bucket is one task's work.
BUCKET_ROWS = 100_000


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    z = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class BinaryFuse:
    """Three-wise binary-fuse filter with 16-bit fingerprints (false positives
    1 in 65,536). Cells lie in overlapping segments: a key's three cells are in
    three consecutive ones. Construction peels, round by round, all cells that
    hold one key, and assigns in reverse."""

    def __init__(self, seed: int, segment: int, segments: int, cells: np.ndarray):
        self.seed, self.segment, self.segments, self.cells = seed, segment, segments, cells

    @staticmethod
    def _spots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        low = [h & mask, (h >> np.uint64(18)) & mask, _mix(h, 7) & mask]
        return np.stack([((first + np.uint64(i)) * np.uint64(segment) + low[i]).astype(np.int64) for i in range(3)])

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (_mix(h, 11) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        if n == 0:
            return cls(0, 4, 1, np.zeros(12, np.uint16))
        segment = min(1 << 18, 1 << max(2, int(np.log(n) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, int(np.ceil(n * factor / segment)) - 2)
        for seed in range(1, 1000):
            if seed % 20 == 0:  # very small or unlucky sets: more room
                segments += 1 + segments // 10
            h = _mix(keys, seed)
            spots = cls._spots(h, segment, segments)
            size = (segments + 2) * segment
            count = np.bincount(spots.ravel(), minlength=size)
            which = np.zeros(size, np.int64)
            for row in spots:
                np.bitwise_xor.at(which, row, np.arange(n))
            left, order = np.ones(n, bool), []
            single = np.flatnonzero(count == 1)
            while len(single):
                key, at = np.unique(which[single], return_index=True)
                cell = single[at]
                order.append((key, cell))
                left[key] = False
                for row in spots:
                    np.subtract.at(count, row[key], 1)
                    np.bitwise_xor.at(which, row[key], key)
                touched = np.unique(spots[:, key])
                single = touched[count[touched] == 1]
            if left.any():
                continue
            cells = np.zeros(size, np.uint16)
            for key, cell in reversed(order):
                s = spots[:, key]
                value = cls._print(h[key]) ^ cells[s[0]] ^ cells[s[1]] ^ cells[s[2]]
                cells[cell] = value ^ cells[cell]
            return cls(seed, segment, segments, cells)
        raise RuntimeError("no binary-fuse filter found")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(keys.astype(np.uint64), self.seed)
        s = self._spots(h, self.segment, self.segments)
        return (self.cells[s[0]] ^ self.cells[s[1]] ^ self.cells[s[2]]) == self._print(h)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h long, sha string, bytes long, norm string) of each row's normalised text."""
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), BLANKS, " ")
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    return d.select("doc_id", F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("sha"), F.octet_length("norm").cast("long").alias("bytes"), "norm")


def _bucket(n: int):
    return F.pmod(F.xxhash64("h"), F.lit(n)).cast("int").alias("bucket")


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter row per bucket of the snapshot's digests ``h``."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        fresh()
        f = BinaryFuse.build(pdf["h"].to_numpy().astype(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "seed": [f.seed], "segment": [f.segment],
                             "segments": [f.segments], "cells": [f.cells.tobytes()]})

    return snapshot.select("h", _bucket(buckets)).groupBy("bucket").applyInPandas(
        build, "bucket int, seed int, segment int, segments int, cells binary")


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``incoming`` (h, ...) whose digest the snapshot's filters hold.
    Rows of one bucket meet its one filter row; buckets are of bounded size."""
    columns = incoming.columns

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        fresh()
        if not len(left) or not len(right):
            return left.iloc[:0][columns]
        r = right.iloc[0]
        f = BinaryFuse(int(r["seed"]), int(r["segment"]), int(r["segments"]), np.frombuffer(r["cells"], np.uint16))
        return left.loc[f.contains(left["h"].to_numpy().astype(np.int64).view(np.uint64)), columns]

    return incoming.select("*", _bucket(buckets)).groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, incoming.schema)


KEY = ["sha", "bytes", "h"]


@dataclass(frozen=True)
class Snapshot:
    """A batch that has been worked off, in a folder: ``rows`` (uid, text, digest), ``groups``
    (each distinct text and its rows' number), ``exact`` (those new in this batch, with the
    row that stays) and ``filters`` (``buckets`` of them)."""

    path: str
    buckets: int

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{name}")


def open_snapshot(spark: SparkSession, path: str) -> Snapshot:
    """A snapshot that an earlier run wrote."""
    return Snapshot(path, spark.read.parquet(f"{path}/filters").agg(F.max("buckets")).first()[0] or 1)


def _work_off(spark: SparkSession, docs: DataFrame, snapshots: list[Snapshot], path: str, id_col: str, text_col: str) -> None:
    """Write the batch's rows, groups and exact rows."""
    here = Snapshot(path, 0)
    digests(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()).write.parquet(f"{path}/rows")  # from here on uid names a row
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("first")
    here.table(spark, "rows").groupBy(*KEY).agg(first, F.count("*").alias("n")).write.parquet(f"{path}/groups")
    new = groups = here.table(spark, "groups")
    for s in snapshots:
        positive = screen(groups.select(*KEY, F.col("first.uid").alias("own")), s.table(spark, "filters"), s.buckets)
        hits = stage(spark, positive.join(s.table(spark, "exact").select(*KEY, F.col("first.uid").alias("old")), KEY), "hits")
        new = new.join(_byte_check(hits, here.table(spark, "rows"), s.table(spark, "rows")), KEY, "left_anti")
    new.select(*KEY, "first").write.parquet(f"{path}/exact")


def _seal(spark: SparkSession, path: str, bucket_rows: int) -> Snapshot:
    """Build the filters of a batch's exact rows, once."""
    exact = spark.read.parquet(f"{path}/exact")
    buckets = max(1, -(-exact.count() // bucket_rows))
    build_filters(exact, buckets).withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/filters")
    return Snapshot(path, buckets)


def deduplicate(spark: SparkSession, batches: list[DataFrame], id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS,
                earlier: Sequence[Snapshot] = (), folder: str | None = None) -> tuple[DataFrame, list[Snapshot]]:
    """Run the batches in order, after the ``earlier`` snapshots. Result, one row for each
    input row: doc_id, keep_id, group_size (rows of earlier snapshots included), kept,
    text_sha256; and all snapshots. With ``folder`` the new snapshots are written there,
    the last one with its filters too, for a later run; without, among the intermediate tables.

    Within a batch, rows of one digest (SHA-256 and length) are one group, by
    partial aggregation. Across batches, one text per filter-positive group is
    compared with the kept one by bytes.
    """
    if not batches:
        raise ValueError("exact deduplication needs at least one batch")
    base = folder.rstrip("/") if folder else f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}"
    sealed = list(earlier)
    for i, docs in enumerate(batches):
        path = f"{base}/batch-{len(earlier) + i}"
        _work_off(spark, docs, sealed, path, id_col, text_col)
        sealed.append(_seal(spark, path, bucket_rows) if folder or i + 1 < len(batches) else Snapshot(path, 0))

    def all_of(name: str, start: int = 0) -> DataFrame:
        parts = [s.table(spark, name).drop("norm").withColumn("batch", F.lit(i)) for i, s in enumerate(sealed) if i >= start]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    sizes = all_of("groups").groupBy(*KEY).agg(F.sum("n").alias("group_size"))
    stays = all_of("exact").select(*KEY, "first", F.col("batch").alias("first_batch"))
    # written first: a join of two plain shuffles, of which Spark splits a very large group
    known = stage(spark, stays.join(sizes, KEY), "known")
    result = all_of("rows", len(earlier)).join(known, KEY).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        ((F.col("uid") == F.col("first.uid")) & (F.col("batch") == F.col("first_batch"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return result, sealed


def exact_dedup(spark: SparkSession, batches: list[DataFrame], id_col: str = "doc_id", text_col: str = "text",
                bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The result of ``deduplicate`` alone."""
    return deduplicate(spark, batches, id_col, text_col, bucket_rows)[0]


def _byte_check(hits: DataFrame, own: DataFrame, old: DataFrame) -> DataFrame:
    """The digests of the hits, after the two rows' texts were compared byte for byte.
    Different texts under one digest end the run: nothing is dropped on the word of a hash."""

    def texts(uid: str, rows: DataFrame, name: str) -> DataFrame:
        # a sort-merge join at every size: few hits would be broadcast, many not
        wanted = hits.select(*KEY, F.col(uid).alias("uid")).hint("merge")
        return wanted.join(rows.select("uid", F.col("norm").alias(name)), "uid").drop("uid")

    both = texts("own", own, "a").join(texts("old", old, "b"), KEY)
    return both.filter(F.when(F.col("a") == F.col("b"), True).otherwise(F.raise_error(F.lit("different texts share a SHA-256")))).select(*KEY)


def split_batches(docs: DataFrame, parts: int = 2, id_col: str = "doc_id") -> list[DataFrame]:
    """``parts`` batches by id range (a null id comes last), as if they had
    arrived one after the other."""
    lo, hi = docs.agg(F.min(id_col).cast("long"), F.max(id_col).cast("long")).first()
    if lo is None or parts < 2:
        return [docs]
    cuts = [lo + (hi - lo + 1) * i // parts for i in range(1, parts)]
    at = F.lit(0)
    for c in cuts:
        at = at + F.when(F.col(id_col).cast("long") < F.lit(c), 0).otherwise(1)
    return [docs.filter(at == i) for i in range(parts)]

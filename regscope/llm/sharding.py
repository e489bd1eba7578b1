"""Byte-balanced sharding of indivisible groups by Karmarkar-Karp differencing.

Rows of equal text are one group and stay together. Every group is a partial
partition: its bytes in one shard, nothing in the others. Differencing takes the
two partial partitions of largest spread (largest minus smallest shard) and joins
them oppositely ordered, largest shard with smallest, until one is left. Buckets
of groups are differenced in parallel, each down to one partial partition; then
buckets of those in turn, ``fan_in`` at a time, until one is left: no task holds
more than ``fan_in`` of them, and the last one the large groups besides.

Size of a row: UTF-8 bytes of its text (null: none) plus 1. Null and empty text
are one group. A group larger than a fair share fills its shard alone; it is not
split. Rows that repeat an id are separate rows. An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regscope.llm.common import stage

SHARDS = 8
FAN_IN = 20_000
HEAVY = 1_000
RANK_ROWS = 20_000


def difference(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the rows of ``sums`` (each a partial partition of k shards). Returns
    the final sums, and for each row and each of its k parts the shard it went to."""
    n, k = sums.shape
    if n == 1:
        return sums[0], np.arange(k, dtype=np.int32)[None, :]
    # a node of the tree of joins: its sums sorted descending, with the children's parts behind each
    order = np.argsort(-sums, axis=1, kind="stable")
    heap = []
    for i in range(n):
        s = sums[i][order[i]].tolist()
        heap.append((s[-1] - s[0], i, s))
    heapq.heapify(heap)
    joins: list[tuple[int, int, list[int]]] = []  # (a, b, new position of each part before sorting)
    where = n
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        s = [p + q for p, q in zip(x, reversed(y), strict=True)]
        perm = sorted(range(k), key=lambda i: -s[i])
        s = [s[i] for i in perm]
        at = [0] * k
        for new, old in enumerate(perm):
            at[old] = new
        joins.append((a, b, at))
        heapq.heapreplace(heap, (s[-1] - s[0], where, s))
        where += 1
    final = np.array(heap[0][2], dtype=np.int64)
    place: list = [None] * where
    place[where - 1] = list(range(k))
    for j in range(len(joins) - 1, -1, -1):
        a, b, at = joins[j]
        to = place[n + j]
        place[n + j] = None
        place[a] = [to[at[i]] for i in range(k)]
        place[b] = [to[at[k - 1 - i]] for i in range(k)]
    out = np.empty((n, k), dtype=np.int32)
    np.put_along_axis(out, order, np.array(place[:n], dtype=np.int32), axis=1)
    return final, out


def _join_level(parts: DataFrame, buckets: int, k: int) -> DataFrame:
    """parts: (id long, sums array<long>) to rows (bucket, id, places) and, with
    id null, (bucket, sums) of the joined partition."""

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        final, places = difference(np.stack(pdf["sums"].to_numpy()).astype(np.int64))
        bucket = int(pdf["bucket"].iloc[0])
        rows = pd.DataFrame({"bucket": bucket, "id": pdf["id"].astype("Int64"), "places": list(places), "sums": None})
        top = pd.DataFrame({"bucket": [bucket], "id": pd.array([None], dtype="Int64"), "places": [None], "sums": [final]})
        return pd.concat([rows, top])

    b = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("long").alias("bucket")
    return parts.select(b, "id", "sums").groupBy("bucket").applyInPandas(join, "bucket long, id long, places array<int>, sums array<long>")


def assign_groups(spark: SparkSession, groups: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN, heavy: int = HEAVY) -> DataFrame:
    """groups: (id long, size long), ids distinct and not negative. Returns (id,
    shard int). Groups above a ``heavy``-th of a fair share, of which there can be
    ``shards * heavy`` at most, wait for the last join, where they balance best."""
    total, count = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    sums = F.concat(F.array("size"), F.array(*[F.lit(0).cast("long")] * (shards - 1))).alias("sums")
    large = F.col("size") > max(1, total // (shards * heavy))
    parts, last = groups.filter(~large).select("id", sums), groups.filter(large).select((-1 - F.col("id")).alias("id"), sums)
    levels, n = [], count
    while True:
        buckets = -(-n // fan_in) or 1
        if buckets == 1:
            parts = parts.unionByName(last)
        level = stage(spark, _join_level(parts, buckets, shards), f"shards{len(levels)}")
        levels.append(level.filter("id is not null").select("bucket", "id", "places"))
        if buckets == 1:
            break
        parts, n = level.filter("id is null").select(F.col("bucket").alias("id"), "sums"), buckets
    # from the top down: where each bucket's parts ended
    top = levels.pop()
    done = top.filter("id < 0").select((-1 - F.col("id")).alias("id"), "places")
    top = top.filter("id >= 0").select("id", "places")
    while levels:
        up = top.select(F.col("id").alias("bucket"), F.col("places").alias("_up"))
        top = levels.pop().join(up, "bucket").select("id", F.transform("places", lambda i: F.element_at("_up", i + 1)).alias("places"))
    return top.unionByName(done).select("id", F.element_at("places", 1).cast("int").alias("shard"))


def shard_by_bytes(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN,
                   rank_rows: int = RANK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("sha"))
    rows = stage(spark, rows, "sizes")
    groups = rows.groupBy("sha").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = stage(spark, groups.withColumn("id", F.monotonically_increasing_id()), "groups")
    placed = assign_groups(spark, groups.select("id", "size"), shards, fan_in)
    where = groups.join(placed, "id").select("sha", "shard")
    rows = rows.join(where, "sha")
    # a rank in each shard without one task per shard: counts of slices, then ranks within
    total = groups.agg(F.sum("n")).first()[0] or 1  # rows, not texts: one text may have most of them
    slices = max(1, -(-total // rank_rows)) * 4
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "sha"), F.lit(slices)).cast("int"))
    rows = stage(spark, rows, "placed")
    counts = rows.groupBy("shard", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_slice").orderBy("doc_id", "sha")
    ranked = rows.withColumn("_r", F.row_number().over(within) - 1).join(starts, ["shard", "_slice"])
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("_start") + F.col("_r")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

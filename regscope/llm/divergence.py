"""How far the sources of a language differ in their words (pair-task sparse merge).

A group is one (lang, source); null counts as ''. Terms are runs of letters and of
characters beyond ASCII, A-Z lowered. A language keeps the terms that stand in at
least ``min_docs`` of its documents (rows, whatever their ids). A group prices a
kept term p = 1 + floor(10^9 (count + 2) / (N + 2 V)): N its occurrences of kept
terms, V the kept terms of its language; two prices differ by floor((p - q)^2 / (p + q)).

1. Documents are counted in tasks, a bounded amount of text at a time, so that a
   frequent word is one row per slice of text; sums follow by an aggregation.
2. Kept terms get numbers: a language's terms are dealt to blocks of about ``BLOCK``
   by hash, and numbered within. A group's terms in a block are one sorted array of
   (number, count): bounded, however large a source or a vocabulary is.
3. For each unordered pair of a language's groups and each block, one task is given
   the two arrays. A galloping intersection finds the terms both have; their prices,
   and those of terms one side lacks, either way, are added. Terms that both lack
   all cost the same, so they are counted and priced once per pair.

Every group has a row for each other source of its language, which is what the
report is: its rows grow with the square of a language's sources, never with
documents. Groups without text or terms take part. Counts are 64-bit integers and
prices are exact: nothing is rounded but by the formula's floors. An empty table
gives an empty result; columns other than text, lang and source are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regscope.llm.common import stage

# Fixed values of the contract.
SCALE = 1_000_000_000
SMOOTH = 2
MIN_DOCS = 10
TOP = 10

#: Terms of a block, about; bounds every array and every numbering task.
BLOCK = 1 << 16
#: Text (bytes) and entries that a counting task holds before it sends them on.
HELD_BYTES = 64 << 20
HELD_TERMS = 400_000
#: A longer text is counted in pieces of this size; entries are looked at as often.
PIECE = 1 << 20
#: Parts that a language's terms are dealt to where they meet its number of blocks.
PARTS = 256

#: Bytes that end a term become blanks, A-Z become a-z; bytes of other characters stay.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

COUNTED = "lang string, source string, term string, n long, docs long"
PRICED = "lang string, a string, b string, value decimal(38,0), union long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    clean = text.translate(_TABLE)
    at = 0
    while at < len(clean):
        end = at + PIECE
        if end < len(clean):
            cut = clean.rfind(b" ", at, end)
            end = cut if cut > at else (clean.find(b" ", end) + 1 or len(clean))
        yield clean[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term) with its occurrences and documents, a slice of text at a time."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = looked = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal size, looked
        for (lang, source), (n, docs) in held.items():
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()), pa.array(list(n), pa.binary()).cast(pa.string()),
                 pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
        held.clear()
        size = looked = 0

    for b in batches:
        text, lang, source = (b.column(i) for i in range(3))
        for i in range(b.num_rows):
            value = text[i].as_buffer()
            if value is None or not value.size:
                continue
            n, docs = held.setdefault((lang[i].as_py(), source[i].as_py()), (Counter(), Counter()))
            own: set[bytes] = set()
            for part in terms(value.to_pybytes()):
                n.update(part)
                own.update(part)
            docs.update(own)
            size += value.size
            if size - looked >= PIECE:
                looked = size
                if size >= HELD_BYTES or sum(len(c) for c, _ in held.values()) >= HELD_TERMS:
                    yield from flush()
    yield from flush()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all documents."""
    rows = docs.select(F.col("text").cast("string").cast("binary").alias("text"), *_group(docs))
    return rows.mapInArrow(_count, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _group(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def vocabulary(counts: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK) -> DataFrame:
    """(lang, term, block, id, lang_n) of the kept terms; ids are dense within a block."""
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= min_docs)
    blocks = kept.groupBy("lang").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    # a language may hold most terms: they meet its one row of ``blocks`` in many parts
    parts = blocks.select("lang", "blocks", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    dealt = kept.withColumn("part", F.pmod(F.hash("term"), F.lit(PARTS))).join(parts, ["lang", "part"]).select("lang", "term", "lang_n", F.pmod(F.xxhash64("term"), "blocks").alias("block"))
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    return dealt.select("lang", "term", "block", (number - 1).alias("id"), "lang_n")


def price(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), by long division: no product
    leaves 64 bits while total + 2 kept is below 9 * 10^15."""
    of = np.int64(total + SMOOTH * kept)
    rest = np.asarray(count, np.int64) + SMOOTH
    out = np.zeros_like(rest)
    for _ in range(3):  # 10^9, a thousand at a time
        rest = rest * 1000
        out = out * 1000 + rest // of
        rest = rest % of
    return out + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(small: np.ndarray, large: np.ndarray, run: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Where values of two ascending arrays are equal: positions in each. A run of
    the smaller array leaps ahead in the larger by doubling steps until it is past
    the run's last value, and only what lies between is searched."""
    if len(small) > len(large):
        j, i = gallop(large, small, run)
        return i, j
    found_s, found_l, low = [], [], 0
    for s in range(0, len(small), run):
        part = small[s:s + run]
        step, high = run, low
        while high < len(large) and large[high] < part[-1]:
            high += step
            step *= 2
        high = min(high + 1, len(large))
        at = low + np.searchsorted(large[low:high], part)
        hit = at < len(large)
        hit[hit] = large[at[hit]] == part[hit]
        found_s.append(s + np.flatnonzero(hit))
        found_l.append(at[hit])
        low = int(at[-1])
    return (np.concatenate(found_s), np.concatenate(found_l)) if found_s else (np.empty(0, np.int64), np.empty(0, np.int64))


def _side(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A group's sorted numbers and counts in one block."""
    if not table.num_rows:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    cell = table["terms"].combine_chunks()[0].values
    return cell.field("id").to_numpy(zero_copy_only=False), cell.field("n").to_numpy(zero_copy_only=False)


def _merge(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """One pair in one block: the priced difference of every term that either has."""
    lang, a, b, _ = (k.as_py() for k in key)
    some = left if left.num_rows else right
    total_a, total_b, kept = (some[c][0].as_py() for c in ("total_a", "total_b", "kept"))
    (ids_a, n_a), (ids_b, n_b) = _side(left), _side(right)
    i, j = gallop(ids_a, ids_b)
    alone_a, alone_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
    alone_a[i], alone_b[j] = False, False
    none_a, none_b = (price(np.zeros(1, np.int64), t, kept) for t in (total_a, total_b))
    p, q = price(n_a, total_a, kept), price(n_b, total_b, kept)
    value = int(difference(p[i], q[j]).sum()) + int(difference(p[alone_a], none_b).sum()) + int(difference(none_a, q[alone_b]).sum())
    return pa.table({"lang": [lang], "a": [a], "b": [b], "value": pa.array([value]).cast(pa.decimal128(38, 0)),
                     "union": pa.array([len(ids_a) + len(ids_b) - len(i)], pa.int64())})


def _exact_price(count: Column, total: Column, kept: Column) -> Column:
    wide = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return _div(wide, (total + SMOOTH * kept).cast("decimal(20,0)")) + 1


def _div(x: Column, y: Column) -> Column:
    """Whole part of x / y; null where y is 0."""
    return F.call_function("div", x, F.nullif(y, F.lit(0).cast("decimal(1,0)")))


def _exact_difference(p: Column, q: Column) -> Column:
    apart = (p - q).cast("decimal(18,0)")
    return _div(apart * apart, (p + q).cast("decimal(18,0)"))


def divergence(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank, p, q. Pairs: p and q
    are null (each term has its own); terms: the group's and the language's price."""
    counts = stage(spark, count_terms(docs), "term-counts")
    known = stage(spark, vocabulary(counts, min_docs, block), "vocabulary")
    held = stage(spark, counts.select("lang", "source", "term", "n").join(known, ["lang", "term"]), "kept-terms")
    languages = known.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    sums = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stage(spark, docs.select(*_group(docs)).distinct().join(sums, ["lang", "source"], "left").join(languages, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")]), "term-groups")
    return _pairs(held, groups).unionByName(_terms(held, groups, top))


def _pairs(held: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "kept")
    b = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = a.join(b, "lang").filter(F.col("a") < F.col("b"))
    arrays = held.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("terms"))
    sides = []
    for side in ("a", "b"):
        own = arrays.withColumnRenamed("source", side)
        both = own.join(pairs, ["lang", side])  # both sides come from one table: alias tells their columns apart
        sides.append(both.select(*[F.col(c).alias(c) for c in ("lang", "a", "b", "block", "terms", "total_a", "total_b", "kept")]).groupBy("lang", "a", "b", "block"))
    merged = sides[0].cogroup(sides[1]).applyInArrow(_merge, PRICED)
    priced = merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("union").alias("union"))
    zero = F.lit(0).cast("long")
    absent = _exact_difference(_exact_price(zero, F.col("total_a"), F.col("kept")), _exact_price(zero, F.col("total_b"), F.col("kept")))
    lacking = F.col("kept") - F.coalesce("union", zero)
    value = (F.coalesce("value", F.lit(0).cast("decimal(38,0)")) + F.when(F.col("kept") > 0, lacking * absent).otherwise(0)).cast("long")
    one = pairs.join(priced, ["lang", "a", "b"], "left").select("lang", "a", "b", value.alias("value"))
    ways = one.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way"), "value")
    return _ranked(ways.select("lang", "way.*", F.lit("pair").alias("part"), "value", *[F.lit(None).cast("long").alias(c) for c in "pq"]))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"), "p", "q")


def _terms(held: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    rows = held.join(groups, ["lang", "source"])
    p = _exact_price(F.col("n"), F.col("total"), F.col("kept"))
    q = _exact_price(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    rows = rows.withColumn("value", _exact_difference(F.col("p"), F.col("q")))
    return _ranked(rows).filter(F.col("rank") <= top)

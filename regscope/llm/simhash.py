"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

Fingerprint: texts have A-Z lower-cased and split at ASCII blanks; every run of
``shingle`` words (repeats included; fewer words: all of them) is hashed with
XXH64, seed 42; a bit is 1 where over half the hashes have it. No word: zero.

Two fingerprints link when at most 3 of 64 bits differ. A fingerprint is cut in
three segments of 22, 21 and 21 bits, each a word of the perfect binary Golay
code [23,12,7] with zeros in the unused places. A segment decodes to its nearest
codeword (at most 3 bits away); its nearby codewords are those at most 4 bits
away: that one, and, if it is 3 away, five more. If two segments differ in at
most one bit, then the nearest codeword of one is nearby the other, so 12-bit
codeword indices serve as keys. Where errors can be (pigeonhole):

- some segment has none: then of the other two one has at most one. Key: the
  first one's bits and the second one's codeword index, for all six pairs;
- each segment has one: then one half of the third is without error. Key: the
  indices of the first two and that half's bits.

Every fingerprint is filed under 8 keys and looked up under at most 96, whatever
the number of fingerprints; matches are verified by their bit distance. Keys are
at least 33 bits wide, so that chance matches are few.

Equal fingerprints are one node: groups of copies are never paired. Null text has
no words. A row of null id takes part through its fingerprint; a component of
such rows alone has a null id. Repeated rows are rows. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.llm.common import stage
from regscope.llm.components import connected_components
from regscope.llm.words import chunks, fresh, texts

# The contract's hash seed, and the code's generator polynomial.
SEED = 42
GENERATOR = 0b110001110101
SHINGLE = 3
DISTANCE = 3
#: Words above which a text is counted in pieces.
LONG = 200_000
SEGMENTS = ((0, 22), (22, 21), (43, 21))


_LANES = np.uint64(0x0101010101010101)


def _shingles(words: list[bytes], shingle: int) -> list[bytes]:
    if len(words) <= shingle:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))  # noqa: B905 - ends with the last window


def _long(words: list[bytes], shingle: int) -> np.uint64:
    """A very long text's fingerprint, counted piece by piece."""
    n, ones = len(words) - shingle + 1, np.zeros(64, np.int64)
    for i in range(0, n, LONG):
        part = _shingles(words[i:min(i + LONG, n) + shingle - 1], shingle)
        h = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), dtype=np.uint64, count=len(part))
        ones += np.array([int((h >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)])
    return np.uint64(sum(1 << b for b in range(64) if 2 * ones[b] > n))


def fingerprints_of(held: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of texts. Bits are counted eight at a time: one bit of each of
    a hash's bytes, summed in byte lanes over at most 255 hashes, then as numbers."""
    words = [t.lower().split() for t in held]
    out = np.zeros(len(held), np.uint64)
    for i, w in enumerate(words):
        if len(w) > LONG:
            out[i] = _long(w, shingle)
            words[i] = []
    parts = [_shingles(w, shingle) for w in words]
    counts = np.array([len(p) for p in parts], np.int64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    h = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(parts), repeat(SEED)), dtype=np.uint64, count=int(counts.sum()))
    blocks = -(-counts[full] // 255)
    first = np.cumsum(blocks) - blocks  # each text's first block
    within = np.arange(blocks.sum()) - np.repeat(first, blocks)
    bounds = np.repeat(np.cumsum(counts[full]) - counts[full], blocks) + 255 * within
    for bit in range(8):
        lanes = np.add.reduceat((h >> np.uint64(bit)) & _LANES, bounds).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), first, axis=0)  # (texts, bytes)
        for byte in range(8):
            most = ones[:, byte] * 2 > counts[full]
            out[full] |= most.astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for b in batches:
            held = texts(b.column("text"))
            fp = np.concatenate([fingerprints_of(held[i:j], shingle) for i, j in chunks(map(len, held))] or [np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_key"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _syndrome(x: int) -> int:
    for bit in range(22, 10, -1):
        if x >> bit & 1:
            x ^= GENERATOR << (bit - 11)
    return x


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(syndrome of each byte in each of three places, error patterns of each
    syndrome (the nearest codeword's first), how many there are: 1 or 6)."""
    by_byte = np.array([[_syndrome((b << 8 * i) & 0x7FFFFF) for b in range(256)] for i in range(3)], np.uint32)
    patterns: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            patterns[_syndrome(e)].append(e)
    errors = np.array([p + [p[0]] * (6 - len(p)) for p in patterns], np.uint32)
    return by_byte, errors, np.array([len(p) for p in patterns], np.int64)


def codewords(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the codewords nearby each 23-bit word, (n, 6), and how many count."""
    by_byte, errors, count = golay_tables()
    x = x.astype(np.uint32)
    s = by_byte[0][x & 255] ^ by_byte[1][x >> 8 & 255] ^ by_byte[2][x >> 16]
    return (x[:, None] ^ errors[s]) >> 11, count[s]


def _pairs(n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and second index of every combination of n[row] by m[row]."""
    total = n * m
    row = np.repeat(np.arange(len(n)), total)
    at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return row, at // m[row], at % m[row]


def keys(fp: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the keys under which fingerprints are filed or, with
    ``probe``, looked up."""
    fp = fp.astype(np.uint64)
    seg = [(fp >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
    code = [codewords(s) for s in seg]
    if not probe:
        code = [(c, np.ones_like(n)) for c, n in code]
    rows, out = [], []

    def add(tag: int, row: np.ndarray, key: np.ndarray) -> None:
        rows.append(row)
        out.append(np.uint64(tag) << np.uint64(56) | key)

    tag = 0
    one = np.ones(len(fp), np.int64)
    for i in range(3):
        for j in range(3):
            if i != j:
                c, n = code[j]
                row, _, at = _pairs(one, n)
                add(tag, row, seg[i][row] << np.uint64(12) | c[row, at].astype(np.uint64))
                tag += 1
    (a, na), (b, nb) = code[0], code[1]
    row, p, q = _pairs(na, nb)
    both = a[row, p].astype(np.uint64) << np.uint64(12) | b[row, q].astype(np.uint64)
    for half, (shift, mask) in enumerate(((0, (1 << 10) - 1), (10, (1 << 11) - 1))):
        add(tag + half, row, both << np.uint64(12) | ((seg[2][row] >> np.uint64(shift)) & np.uint64(mask)))
    return np.concatenate(rows), np.concatenate(out)


def _filed(fps: DataFrame, probe: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fp), 2000):
                row, key = keys(fp[i:i + 2000], probe)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp[i:i + 2000][row].view(np.int64))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints at most ``distance`` (3) bits apart.
    Both sides are many times the rows the planner takes them for (8 and up to 96 keys a
    fingerprint): sorted and merged, never broadcast."""
    if not 0 <= distance <= 3:
        raise ValueError("the code's keys cover distances up to 3")
    left = _filed(fps, False).withColumnRenamed("fp", "x")
    right = _filed(fps, True).withColumnRenamed("fp", "y")
    near = (F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance)
    return left.join(right.hint("merge"), "key").filter(near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id; and component (a
    fingerprint that names the component), text_key. Tables of a row per document or
    fingerprint are merged, as files of few bytes hold many rows."""
    marked = stage(spark, fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = stage(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = connected_components(spark, links(nodes, distance))
    joined = nodes.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of = joined.select("fp", "component").join(names.hint("merge"), "component")
    return marked.join(of.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component", "text_key")


def representatives(found: DataFrame) -> DataFrame:
    """The row that stays of each component of ``near_duplicates``: that of
    smallest id (null last), as ``__llm_row``."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    f = found.groupBy("component").agg(first)
    return f.select(F.concat_ws("|", F.coalesce(F.col("first.doc_id").cast("string"), F.lit("-")), F.col("first.text_key").cast("string")).alias("__llm_row")).distinct()

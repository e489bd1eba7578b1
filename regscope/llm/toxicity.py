"""Toxicity by a factorization machine over hashed terms.

Terms: runs of word characters of a blank-separated word, lower-cased, and their
first 3 to 6 characters (marked as stems); each is hashed to 20 bits, and a
document has a term or has it not. Of all hashed terms the ``features`` most
associated with the label (likelihood ratio on the training rows) are kept. The
machine scores a document by a constant, a weight for each of its features, and
the product of two features' factor vectors for every pair of them, so that two
terms together can count for more, or less, than each alone.

It is trained on at most ``max_rows`` labelled rows (those of smallest id hash),
in one task of bounded size; the model, a bounded array, goes to all tasks. A
score needs a document's text only. Documents of any length are read whole. Null
and empty text score as a document without features. Without labelled rows the
score is a constant. Label rows of null id or null label are not used; of rows that
repeat an id the one of smallest text hash is used. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regscope.llm.common import stage
from regscope.llm.words import CACHE_LENGTH, CACHE_WORDS, chunks, fresh, texts

MAX_ROWS = 20_000
FEATURES = 4_096
FACTORS = 8
EPOCHS = 30
THRESHOLD = 0.3
BITS = 20
#: Least likelihood ratio (twice the gain) of a kept term: 1 in 10,000 by chance.
MIN_RATIO = 15.0
STEMS = range(3, 7)
_PIECE = re.compile(r"\w+")


def terms(word: str) -> set[int]:
    """Hashed terms of one blank-separated word."""
    out = set()
    for piece in _PIECE.findall(word.lower()):
        out.add(zlib.crc32(piece.encode()) >> (32 - BITS))
        for n in STEMS:
            if len(piece) >= n:
                out.add(zlib.crc32(b"^" + piece[:n].encode()) >> (32 - BITS))
    return out


class WordTerms(dict):
    """word (bytes) to its terms, or to those in ``chosen`` alone (as their numbers),
    as unsigned 32-bit numbers."""

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes) -> bytes:
        found = terms(word.decode())
        kept = found if self.chosen is None else [self.chosen[t] for t in found if t in self.chosen]
        value = np.fromiter(kept, dtype="<u4", count=len(kept)).tobytes()
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value

    def of(self, text: bytes) -> np.ndarray:
        return np.unique(np.frombuffer(b"".join(map(self.__getitem__, set(text.split()))), "<u4")).astype(np.int64)


class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of factor products)."""

    def __init__(self, chosen: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.chosen, self.bias, self.weight, self.factor = chosen, bias, weight, factor

    @staticmethod
    def choose(seen: np.ndarray, documents: np.ndarray, features: int) -> np.ndarray:
        """The terms most associated with the label. ``seen[c, t]``: documents of
        label c that have term t; ``documents[c]``: documents of label c."""
        n = np.maximum(documents, 1).astype(float)
        both = seen.sum(axis=0)
        gain = np.zeros(seen.shape[1])
        for count, total in ((seen, n), (n[:, None] - seen, n)):
            expected = count.sum(axis=0)[None, :] * total[:, None] / total.sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                gain += np.where(count > 0, count * np.log(count / expected), 0).sum(axis=0)
        gain[both < 2] = 0
        best = np.argsort(-gain, kind="stable")[:features]
        return np.sort(best[2 * gain[best] > MIN_RATIO])

    @classmethod
    def train(cls, chosen: np.ndarray, own: list[np.ndarray], label: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS,
              rate: float = 0.1, decay: float = 1e-4, batch: int = 128, drop: float = 0.2, seed: int = 7) -> FactorizationMachine:
        """own: numbers of the chosen terms each document has."""
        label = np.asarray(label, np.int64)
        share = (label.sum() + 0.5) / (len(label) + 10.0)
        bias = float(np.log(share / (1 - share)))
        rng = np.random.default_rng(seed)
        w, v = np.zeros(len(chosen)), rng.normal(0, 0.01, (len(chosen), factors))
        model = cls(chosen, bias, w, v)
        if not len(chosen) or label.min() == label.max():
            return model
        gw, gv, gb = np.full(w.shape, 1e-6), np.full(v.shape, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(own))
            for i in range(0, len(order), batch):
                part = order[i:i + batch]
                counts = np.array([len(own[j]) for j in part])
                at = np.concatenate([own[j] for j in part]) if counts.sum() else np.empty(0, np.int64)
                doc = np.repeat(np.arange(len(part)), counts)
                left = rng.random(len(at)) >= drop  # each term must also do without the others
                at, doc = at[left], doc[left]
                total = np.zeros((len(part), factors))
                np.add.at(total, doc, v[at])
                z = model.bias + np.bincount(doc, weights=w[at], minlength=len(part)) \
                    + 0.5 * ((total ** 2).sum(axis=1) - np.bincount(doc, weights=(v[at] ** 2).sum(axis=1), minlength=len(part)))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[part]) / len(part)
                db = error.sum()
                gb += db * db
                model.bias -= rate * db / np.sqrt(gb)
                used, back = np.unique(at, return_inverse=True)
                if not len(used):
                    continue
                dw = np.bincount(back, weights=error[doc]) + decay * w[used]
                dv = np.zeros((len(used), factors))
                np.add.at(dv, back, error[doc][:, None] * (total[doc] - v[at]))
                dv += decay * v[used]
                gw[used] += dw ** 2
                gv[used] += dv ** 2
                w[used] -= rate * dw / np.sqrt(gw[used])
                v[used] -= rate * dv / np.sqrt(gv[used])
        return model

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """rows: numbers of the chosen features each document has."""
        z = np.full(len(rows), self.bias)
        for i, r in enumerate(rows):
            if len(r):
                f = self.factor[r]
                z[i] += self.weight[r].sum() + 0.5 * ((f.sum(axis=0) ** 2).sum() - (f ** 2).sum())
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, features: int = FEATURES,
          factors: int = FACTORS, epochs: int = EPOCHS) -> FactorizationMachine:
    """docs (doc_id, text), labels (doc_id, toxic). The sample of at most
    ``max_rows`` ids is broadcast to the documents; counts of hashed terms, and then
    each document's chosen terms, meet in one task: neither grows with the texts."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
        .filter("id is not null and toxic is not null").orderBy(F.xxhash64("id"), "id", "toxic").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("key")).join(F.broadcast(wanted), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        held = WordTerms()
        for b in batches:
            text = b.column("text")
            for i, j in chunks(_sizes(text)):
                found = pa.array([held.of(t).astype("<u4").tobytes() for t in texts(text.slice(i, j - i))], pa.binary())
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("id", "toxic", "key")), found], ["id", "toxic", "key", "terms"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a slice of the sample, how many documents of each label have each term."""
        seen = np.zeros((2, (1 << BITS) + 1), np.int64)  # the last place counts documents
        for b in batches:
            for toxic, held in zip(b.column("toxic").to_pylist(), b.column("terms").to_pylist(), strict=True):
                seen[int(toxic != 0), np.frombuffer(held, "<u4")] += 1
                seen[int(toxic != 0), -1] += 1
        label, term = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(label, pa.int64()), pa.array(seen[label, term])], ["term", "label", "n"])

    def pick(table: pa.Table) -> pa.Table:
        seen = np.zeros((2, (1 << BITS) + 1))
        seen[table["label"].to_numpy(), table["term"].to_numpy()] = table["n"].to_numpy()
        chosen = FactorizationMachine.choose(seen[:, :-1], seen[:, -1], features)
        return pa.table({"chosen": pa.array([chosen.astype("<i8").tobytes()], pa.binary())})

    found = rows.select("id", "toxic", "key", "text").mapInArrow(extract, "id long, toxic int, key long, terms binary")
    sample = stage(spark, found.groupBy("id", "toxic").agg(F.min_by("terms", "key").alias("terms")), "toxic-sample")
    # at most two rows for each hashed term, however long the sample's texts are
    counts = sample.select("toxic", "terms").mapInArrow(count, "term long, label long, n long").groupBy("term", "label").agg(F.sum("n").alias("n"))
    picked = stage(spark, counts.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(pick, "chosen binary"), "toxic-terms").first()
    if picked is None:
        return FactorizationMachine.train(np.empty(0, np.int64), [], np.empty(0, np.int64), factors, epochs)
    chosen = np.frombuffer(picked["chosen"], "<i8")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document only the chosen terms, by number."""
        for b in batches:
            own = []
            for held in b.column("terms").to_pylist():
                term = np.frombuffer(held, "<u4").astype(np.int64)
                own.append(np.flatnonzero(np.isin(chosen, term)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("toxic"), pa.array(own, pa.binary())], ["id", "toxic", "terms"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("toxic", "ascending"), ("terms", "ascending")])
        m = FactorizationMachine.train(chosen, [np.frombuffer(t, "<u4").astype(np.int64) for t in table["terms"].to_pylist()], table["toxic"].to_numpy(), factors, epochs)
        return pa.table({"bias": [m.bias], "weight": [m.weight.tobytes()], "factor": [m.factor.tobytes()]})

    kept = sample.mapInArrow(keep, "id long, toxic int, terms binary").withColumn("one", F.lit(1))
    model = stage(spark, kept.groupBy("one").applyInArrow(fit, "bias double, weight binary, factor binary"), "toxic-model").first()
    return FactorizationMachine(chosen, model["bias"], np.frombuffer(model["weight"]), np.frombuffer(model["factor"]).reshape(-1, factors))


def _sizes(text: pa.Array) -> list[int]:
    """Bytes of each text, without making texts of them."""
    return pc.fill_null(pc.binary_length(text.cast(pa.binary())), 0).to_pylist()


def score(spark: SparkSession, docs: DataFrame, model: FactorizationMachine, name: str = "score") -> DataFrame:
    """``docs`` (any columns, with text) plus the score under ``name``."""
    shared = spark.sparkContext.broadcast((model.chosen, model.bias, model.weight, model.factor))
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        m = FactorizationMachine(*shared.value)
        held = WordTerms({int(t): i for i, t in enumerate(m.chosen)})
        for b in batches:
            for i, j in chunks(_sizes(b.column(text_at))):
                part = b.slice(i, j - i)
                s = m.scores([held.of(t) for t in texts(part.column(text_at))])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def training_fold(id_col: str = "doc_id"):
    """Rows whose label may be learned: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")), F.lit(4)) != 2


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(spark, docs, labels.filter(training_fold()), max_rows)
    rows = score(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return rows.select("doc_id", F.coalesce(~training_fold(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

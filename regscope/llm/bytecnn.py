"""Document quality by a byte-level convolutional network, in numpy.

A text's UTF-8 bytes are cut into chunks of ``CHUNK`` bytes that overlap by
``CHUNK - STEP`` and cover all of it: the last chunk ends where the text ends, and
only a text shorter than one chunk is padded. Within a chunk each byte has a short
vector, filters slide over ``WIDTH`` bytes, and each filter keeps its greatest
response (max-pooling). Over a document's chunks these give, per filter, the
greatest and the mean response; one hidden layer combines them into one probability
that the label is 1. The mean tells text from what responds to few filters, such as
one word over and over.

The network is trained on at most ``max_rows`` labelled rows (those of smallest id
hash) and ``max_chunks`` evenly spaced chunks of each, in one task of bounded size;
it has some 3,000 numbers and goes to all tasks. A score reads every byte of a text
of any length, a bounded number of chunks at a time, and nothing but the text.

Null and empty text are a chunk of padding. Without labelled rows, or with one label
only, the score is a constant. Label rows of null id or null label are not used; of
rows that repeat an id the one of smallest text hash is used. Rows that repeat are
each scored, and alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regscope.llm.common import stage
from regscope.llm.words import chunks as slices
from regscope.llm.words import fresh

MAX_ROWS = 6_000
MAX_CHUNKS = 48
EPOCHS = 10
THRESHOLD = 0.5

CHUNK = 256
STEP = 224
WIDTH = 8
STRIDE = 2
EMBEDDING = 6
FILTERS = 24
HIDDEN = 16
PAD = 256
#: Digits of a score: more would depend on which texts were convolved together.
DIGITS = 6
#: Chunks convolved at a time.
AT_ONCE = 512

_WINDOWS = (CHUNK - WIDTH) // STRIDE + 1


def starts(size: int) -> np.ndarray:
    """Where a text's chunks begin."""
    if size <= CHUNK:
        return np.zeros(1, np.int64)
    at = np.arange(0, size - CHUNK + STEP, STEP, dtype=np.int64)
    return np.minimum(at, size - CHUNK)


def cut(text: bytes, at: np.ndarray) -> np.ndarray:
    """Chunks (rows of byte numbers) that begin at the given places."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < CHUNK:
        out = np.full((1, CHUNK), PAD, np.int16)
        out[0, :len(data)] = data
        return out
    return data[at[:, None] + np.arange(CHUNK)].astype(np.int16)


def spaced(size: int, most: int) -> np.ndarray:
    """At most ``most`` of a text's chunks, evenly spaced."""
    at = starts(size)
    return at if len(at) <= most else at[np.linspace(0, len(at) - 1, most).astype(np.int64)]


@dataclass
class ByteCnn:
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(seed: int, bias: float) -> ByteCnn:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return ByteCnn(normal(PAD + 1, EMBEDDING, scale=0.5), normal(WIDTH * EMBEDDING, FILTERS, scale=(WIDTH * EMBEDDING) ** -0.5), np.zeros(FILTERS, np.float32),
                       normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5), np.zeros(HIDDEN, np.float32), normal(HIDDEN, scale=HIDDEN ** -0.5), np.full(1, bias, np.float32))

    def numbers(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def to_bytes(self) -> bytes:
        return np.concatenate([a.ravel() for a in self.numbers()]).astype("<f4").tobytes()

    @staticmethod
    def from_bytes(blob: bytes) -> ByteCnn:
        flat, at, parts = np.frombuffer(blob, "<f4"), 0, []
        for a in ByteCnn.start(0, 0.0).numbers():
            parts.append(flat[at:at + a.size].reshape(a.shape).copy())
            at += a.size
        return ByteCnn(*parts)

    def windows(self, rows: np.ndarray) -> np.ndarray:
        """(chunks, windows, WIDTH * EMBEDDING): what each filter sees in each place."""
        seen = self.embedding[rows].reshape(len(rows), -1)
        view = np.lib.stride_tricks.as_strided(seen, (len(rows), _WINDOWS, WIDTH * EMBEDDING), (seen.strides[0], STRIDE * EMBEDDING * 4, 4), writeable=False)
        return np.ascontiguousarray(view)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Each chunk's greatest response of each filter."""
        out = np.empty((len(rows), FILTERS), np.float32)
        for i in range(0, len(rows), AT_ONCE):
            x = self.windows(rows[i:i + AT_ONCE])
            z = (x.reshape(-1, WIDTH * EMBEDDING) @ self.filters).reshape(len(x), _WINDOWS, FILTERS)
            out[i:i + AT_ONCE] = z.max(axis=1)
        return np.maximum(out + self.filter_bias, 0)

    def combine(self, pooled: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities of documents with so many chunks each."""
        first = np.cumsum(counts) - counts
        u = np.concatenate([np.maximum.reduceat(pooled, first, axis=0), np.add.reduceat(pooled, first, axis=0) / counts[:, None]], axis=1)
        h = np.maximum(u @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip((h @ self.out + self.out_bias[0]).astype(np.float64), -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Short texts are convolved together, a long one by itself, in runs of chunks."""
        pooled, counts = [], []
        held: list[np.ndarray] = []
        for t in texts:
            at = starts(len(t))
            counts.append(len(at))
            for i in range(0, len(at), AT_ONCE):
                held.append(cut(t, at[i:i + AT_ONCE]))
                if sum(len(h) for h in held) >= AT_ONCE:
                    pooled.append(self.pooled(np.concatenate(held)))
                    held = []
        if held:
            pooled.append(self.pooled(np.concatenate(held)))
        return self.combine(np.concatenate(pooled), np.array(counts)) if texts else np.empty(0)

    def gradients(self, rows: np.ndarray, counts: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss of some documents (their chunks one after the other) and its slopes.
        Only the window that a filter responds to most in a chunk has one."""
        m, first = len(rows), np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(counts)), counts)
        x = self.windows(rows)
        z = (x.reshape(-1, WIDTH * EMBEDDING) @ self.filters).reshape(m, _WINDOWS, FILTERS)
        place = z.argmax(axis=1)
        raw = np.take_along_axis(z, place[:, None, :], axis=1)[:, 0] + self.filter_bias
        pooled = np.maximum(raw, 0)
        best, mean = np.maximum.reduceat(pooled, first, axis=0), np.add.reduceat(pooled, first, axis=0) / counts[:, None]
        u = np.concatenate([best, mean], axis=1)
        pre = u @ self.hidden + self.hidden_bias
        h = np.maximum(pre, 0)
        p = 1 / (1 + np.exp(-np.clip(h @ self.out + self.out_bias[0], -30, 30)))
        loss = -float(np.mean(label * np.log(p + 1e-9) + (1 - label) * np.log(1 - p + 1e-9)))
        dz = ((p - label) / len(label)).astype(np.float32)
        d_out, d_out_bias = h.T @ dz, np.array([dz.sum()], np.float32)
        d_pre = np.outer(dz, self.out) * (pre > 0)
        d_hidden, d_hidden_bias = u.T @ d_pre, d_pre.sum(axis=0)
        d_u = d_pre @ self.hidden.T
        # of equal greatest chunks the first has the slope
        top = pooled == best[doc]
        ahead = np.cumsum(top, axis=0)
        before = (ahead - top)[first]
        top &= (ahead - before[doc]) == 1
        d_pooled = (d_u[doc, :FILTERS] * top + d_u[doc, FILTERS:] / counts[doc][:, None]) * (raw > 0)
        seen = x[np.arange(m)[:, None], place]  # (chunks, filters, inputs)
        d_filters = np.einsum("mfk,mf->kf", seen, d_pooled)
        d_seen = (d_pooled[:, :, None] * self.filters.T[None]).reshape(-1, EMBEDDING)
        which = rows[np.arange(m)[:, None, None], (place * STRIDE)[:, :, None] + np.arange(WIDTH)].ravel()
        d_embedding = np.stack([np.bincount(which, weights=d_seen[:, k], minlength=PAD + 1) for k in range(EMBEDDING)], axis=1)
        return loss, [d_embedding, d_filters, d_pooled.sum(axis=0), d_hidden, d_hidden_bias, d_out, d_out_bias]

    @classmethod
    def train(cls, docs: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 32, seed: int = 11) -> ByteCnn:
        """docs: each one's chunks. Adam with a rate that falls to a tenth."""
        label = np.asarray(label, np.float32)
        share = (float(label.sum()) + 0.5) / (len(label) + 1.0)
        model = cls.start(seed, float(np.log(share / (1 - share))))
        if not len(label) or label.min() == label.max():
            model.out[:] = 0
            return model
        rng = np.random.default_rng(seed)
        numbers = model.numbers()
        first, second = [np.zeros_like(a) for a in numbers], [np.zeros_like(a) for a in numbers]
        steps, t = epochs * -(-len(docs) // batch), 0
        for _ in range(epochs):
            order = rng.permutation(len(docs))
            for i in range(0, len(order), batch):
                part = order[i:i + batch]
                rows = np.concatenate([docs[j] for j in part])
                _, slopes = model.gradients(rows, np.array([len(docs[j]) for j in part]), label[part])
                t += 1
                pace = rate * (1 - 0.9 * t / steps) * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
                for a, m1, m2, d in zip(numbers, first, second, slopes, strict=True):
                    m1 += 0.1 * (d - m1)
                    m2 += 0.001 * (d * d - m2)
                    a -= pace * m1 / (np.sqrt(m2) + 1e-8)
        return model


def training_fold(id_col: str = "doc_id") -> Column:
    """Rows whose label may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return F.pmod(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")), F.lit(3)) != 1


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS,
          max_chunks: int = MAX_CHUNKS, epochs: int = EPOCHS) -> ByteCnn:
    """docs (doc_id, text), labels (doc_id and ``label_col``). The sample's ids are
    broadcast to the documents; its chunks, bounded by ``max_rows`` times
    ``max_chunks``, meet in one task."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter("id is not null and label is not null").orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").cast("binary").alias("text"), F.xxhash64("text").alias("key")).join(F.broadcast(wanted), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        for b in batches:
            for i in range(b.num_rows):
                text = b.column("text")[i].as_py() or b""
                found = cut(text, spaced(len(text), max_chunks)).astype("<i2").tobytes()
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, 1) for c in ("id", "label", "key")), pa.array([found], pa.binary())], ["id", "label", "key", "chunks"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("label", "ascending"), ("chunks", "ascending")])
        kept = [np.frombuffer(c, "<i2").reshape(-1, CHUNK) for c in table["chunks"].to_pylist()]
        return pa.table({"model": pa.array([ByteCnn.train(kept, table["label"].to_numpy(), epochs).to_bytes()], pa.binary())})

    found = rows.select("id", "label", "key", "text").mapInArrow(extract, "id long, label int, key long, chunks binary")
    sample = stage(spark, found.groupBy("id", "label").agg(F.min_by("chunks", "key").alias("chunks")), "quality-sample")
    fitted = stage(spark, sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fit, "model binary"), "quality-model").first()
    return ByteCnn.train([], np.empty(0)) if fitted is None else ByteCnn.from_bytes(fitted["model"])


def score(spark: SparkSession, docs: DataFrame, model: ByteCnn, name: str = "score") -> DataFrame:
    """``docs`` (any columns, with text) plus the probability under ``name``."""
    shared = spark.sparkContext.broadcast(model.to_bytes())
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh()
        m = ByteCnn.from_bytes(shared.value)
        for b in batches:
            text = b.column(text_at).cast(pa.binary())
            sizes = [len(t.as_buffer() or b"") for t in text]
            found = [m.score([t or b"" for t in text.slice(i, j - i).to_pylist()]) for i, j in slices(sizes)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(found).round(DIGITS) if found else np.empty(0))], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(spark, docs, labels.filter(training_fold()), max_rows=max_rows)
    rows = score(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)
    return rows.select("doc_id", F.coalesce(~training_fold(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

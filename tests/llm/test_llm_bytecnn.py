"""The byte-level network: slopes, plain-loop scores, held-out accuracy, edges."""

import random
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import models as M  # noqa: E402

from regscope.llm import bytecnn as B  # noqa: E402

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score double, held_out string, label int, chunks string"
TEXTS = [b"", b"a", bytes(range(255)), b"x" * B.CHUNK, b"y" * (B.CHUNK + 1), "é日本 ".encode() * 300, b"The The The " * 90, b"### &&& " * 70]


def model():
    return B.ByteCnn.start(5, 0.3)


@pytest.mark.parametrize("size", [0, 1, B.CHUNK, B.CHUNK + 1, B.CHUNK + B.STEP, B.CHUNK + B.STEP + 1, 10_000])
def test_chunks_cover_every_byte(size):
    at = B.starts(size)
    covered = np.zeros(max(size, B.CHUNK), bool)
    for s in at:
        covered[s:s + B.CHUNK] = True
    assert covered.all() and (at + B.CHUNK <= max(size, B.CHUNK)).all() and len(set(at.tolist())) == len(at)
    assert (np.diff(at) <= B.STEP).all()


def test_scores_equal_plain_loops():
    m = model()
    want = [M.convolve(m, t, B.CHUNK, B.STEP, B.WIDTH, B.STRIDE) for t in TEXTS[:5] + TEXTS[7:]]
    assert np.allclose(m.score(TEXTS[:5] + TEXTS[7:]), want, atol=1e-5)


def test_score_does_not_depend_on_company(monkeypatch):
    m = model()
    alone = np.concatenate([m.score([t]) for t in TEXTS])
    monkeypatch.setattr(B, "AT_ONCE", 3)
    assert np.allclose(m.score(TEXTS), alone, atol=1e-6)


def test_slopes_equal_differences():
    m = model()
    for a in m.numbers():
        a[...] = a.astype(np.float64)
    docs = [B.cut(t, B.starts(len(t))) for t in TEXTS]
    rows, counts, label = np.concatenate(docs), np.array([len(d) for d in docs]), np.array([0, 1, 0, 1, 1, 1, 0, 0], np.float32)
    # in double precision, so that differences mean something
    for name in ("embedding", "filters", "filter_bias", "hidden", "hidden_bias", "out", "out_bias"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    m.windows = lambda r: np.stack([np.concatenate([m.embedding[r[:, w * B.STRIDE + k]] for k in range(B.WIDTH)], axis=1) for w in range(B._WINDOWS)], axis=1)
    _, slopes = m.gradients(rows, counts, label)
    rng = np.random.default_rng(1)
    for a, d in zip(m.numbers(), slopes, strict=True):
        for _ in range(6):
            at = tuple(int(rng.integers(s)) for s in a.shape)
            old, eps = a[at], 1e-6
            a[at] = old + eps
            up = m.gradients(rows, counts, label)[0]
            a[at] = old - eps
            down = m.gradients(rows, counts, label)[0]
            a[at] = old
            assert abs((up - down) / (2 * eps) - d[at]) < 1e-4


def test_numbers_round_trip():
    m = model()
    assert all(np.array_equal(a, b) for a, b in zip(m.numbers(), B.ByteCnn.from_bytes(m.to_bytes()).numbers(), strict=True))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = {r["doc_id"]: r for r in B.quality(spark, docs, labels).collect()}
    assert len(found) == docs.count()
    truth = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    held = [(found[d]["predicted"], q) for d, q in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for d, r in found.items())
    assert np.mean([p == q for p, q in held]) >= 0.9
    assert np.mean([p for p, q in held if q == 1]) >= 0.95


def small(spark, data):
    return spark.createDataFrame([(d, t, 0.1, "h", 1, "c") for d, t in data], SCHEMA)


def test_edges(spark):
    rng = random.Random(2)
    data = [(i, " ".join(rng.choice(["fine", "words", "here"] if i % 2 else ["###", "&&&"]) for _ in range(60))) for i in range(80)]
    data += [(None, "null id"), (None, None), (500, None), (501, ""), (3, data[3][1]), (3, "other text of id 3"), (502, "w" * 6_000_000), (503, "words here " * 400_000)]
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(80)] + [(None, 1, "t"), (5, None, "t"), (6, 0, "t")], "doc_id long, quality int, text string")
    found = B.quality(spark, small(spark, data).repartition(3), labels).collect()
    assert len(found) == len(data)
    assert all(0 <= r["score"] <= 1 for r in found)
    blank = {r["score"] for r in found if r["doc_id"] in (500, 501)}
    assert len(blank) == 1
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert len(by_id[3]) == 3 and all(r["held_out"] is False for r in by_id[None])
    right = [r["predicted"] == r["doc_id"] % 2 for r in found if r["doc_id"] is not None and r["doc_id"] < 80 and r["doc_id"] != 3]
    assert np.mean(right) > 0.95


def test_same_result_again(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    one, two = ({r["doc_id"]: r["score"] for r in B.quality(spark, d, labels).collect()} for d in (docs, docs.repartition(7, F.rand(3))))
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-5


def test_without_labels(spark):
    data = small(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert len({r["score"] for r in B.quality(spark, data, none).collect()}) == 1
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert len({r["score"] for r in B.quality(spark, data, one).collect()}) == 1
    assert B.quality(spark, data.limit(0), none).count() == 0

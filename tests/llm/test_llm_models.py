"""Operators' inner workings against plain loops, and bounds that must hold at any size."""

import heapq
import random
import sys
from fractions import Fraction
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from regscope.llm import mixing, packing, quality, toxicity, words  # noqa: E402


def machine(n=12, factors=3, seed=4):
    rng = np.random.default_rng(seed)
    return toxicity.FactorizationMachine(np.arange(n) * 7, 0.25, rng.normal(size=n), rng.normal(size=(n, factors)))


def test_scores_equal_the_double_sum_over_pairs():
    m = machine()
    rng = random.Random(1)
    rows = [np.array(sorted(rng.sample(range(12), k)), np.int64) for k in (0, 1, 2, 5, 12)]
    for r, got in zip(rows, m.scores(rows), strict=True):
        z = m.bias + sum(m.weight[i] for i in r)
        z += sum(float(m.factor[i] @ m.factor[j]) for a, i in enumerate(r) for j in r[a + 1:])
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-12


def test_one_training_step_equals_a_plain_loop():
    """One batch, no dropout: AdaGrad on slopes written out pair by pair."""
    n, factors, rate, decay = 5, 2, 0.1, 1e-4
    chosen = np.arange(n)
    own = [np.array(r, np.int64) for r in ([0, 1], [1, 2, 3], [], [0, 4], [2, 4, 1])]
    label = np.array([1, 0, 0, 1, 1])
    m = toxicity.FactorizationMachine.train(chosen, own, label, factors=factors, epochs=1, rate=rate, decay=decay, batch=8, drop=0.0, seed=3)
    v0 = np.random.default_rng(3).normal(0, 0.01, (n, factors))
    share = (label.sum() + 0.5) / (len(label) + 10.0)
    bias = float(np.log(share / (1 - share)))
    db, dw, dv, used = 0.0, np.zeros(n), np.zeros((n, factors)), set()
    for r, y in zip(own, label, strict=True):
        z = bias + sum(float(v0[i] @ v0[j]) for a, i in enumerate(r) for j in r[a + 1:])
        e = (1 / (1 + np.exp(-z)) - y) / len(label)
        db += e
        for i in r:
            used.add(int(i))
            dw[i] += e
            for j in r:
                if j != i:
                    dv[i] += e * v0[j]
    assert abs(m.bias - (bias - rate * db / np.sqrt(1e-6 + db * db))) < 1e-9
    for i in range(n):
        if i in used:
            d = dv[i] + decay * v0[i]
            assert abs(m.weight[i] + rate * dw[i] / np.sqrt(1e-6 + dw[i] ** 2)) < 1e-9
            assert np.allclose(m.factor[i], v0[i] - rate * d / np.sqrt(1e-6 + d ** 2))
        else:
            assert m.weight[i] == 0 and np.allclose(m.factor[i], v0[i])


def test_apportionment_of_many_claimants(spark):
    """Seats equal the highest quotients, found one by one."""
    rng = random.Random(9)
    for n, seats in ((400, 3_000), (300, 37), (50, 0), (1, 9)):
        claims = [rng.choice([0, 1, 5, 1_000, rng.randint(1, 200)]) for _ in range(n)]
        heap = [(-Fraction(c), i, 0) for i, c in enumerate(claims) if c]
        heapq.heapify(heap)
        won = [0] * n
        for _ in range(seats if heap else 0):
            q, i, s = heapq.heappop(heap)
            won[i] += 1
            heapq.heappush(heap, (-Fraction(claims[i], 2 * s + 3), i, s + 1))
        df = spark.createDataFrame([("g", i, float(c), seats, 10**6) for i, c in enumerate(claims)], "g string, i long, c double, seats long, cap long")
        got = {r["i"]: r["won"] for r in mixing.apportion(df, "seats", "c", "cap", "won", ["g"], ["i"]).collect()}
        assert [got[i] for i in range(n)] == won


def test_quotients_listed_grow_with_claimants_only(spark):
    df = spark.range(3_000).select(F.lit("g").alias("g"), F.col("id").alias("i"), (F.lit(16.0) * 31.4999).alias("c"), F.lit(3_000 * 31 + 1_500).alias("seats"), F.lit(10**6).alias("cap"))
    won = mixing.apportion(df, "seats", "c", "cap", "won", ["g"], ["i"])
    assert won.agg(F.sum("won")).first()[0] == 3_000 * 31 + 1_500


def test_unrelated_documents_of_a_host_change_no_verdict(spark):
    rng = random.Random(5)

    def text(k):
        return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(k))

    shared = text(12)
    rows = [(i, f"{shared}\n{text(70)}", "h") for i in range(25)] + [(100 + i, text(80), "h") for i in range(5)]
    more = rows + [(1_000 + i, text(60), "h") for i in range(2_000)]
    one, two = ({r["doc_id"]: (r["removed_words"], r["kept"]) for r in quality.quality_rules(spark, spark.createDataFrame(d, "doc_id long, text string, source string")).collect()}
                for d in (rows, more))
    assert {k: two[k] for k in one} == one and one[0][0] == 12


def test_caches_end_with_their_stage(monkeypatch):
    class Context:
        now = 1

        @staticmethod
        def get():
            return Context

        @staticmethod
        def stageId():
            return Context.now

    monkeypatch.setattr(words, "TaskContext", Context)
    words.fresh()
    words.hashes([b"some", b"words"])
    words.fresh()
    assert b"some" in words._HASHES
    Context.now = 2
    words.fresh()
    assert not words._HASHES and not packing._IDS


def test_long_words_are_not_kept():
    long = b"x" * 1_000
    words.hashes([long, b"y"])
    assert long not in words._HASHES
    held = toxicity.WordTerms()
    assert held.of(long + b" y").size and long not in held


def reference_ids(ids, text):
    return np.array(ids.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def random_texts(rng, n):
    pieces = ["the", "The,", "THE.", "word", "caf\u00e9.", "\u0130.", "\u65e5\u672c\u8a9e,", "a" * 15, "b" * 16, "c" * 15 + ",", "x" * 40 + ".", "\x00", "a\x00", "...", ",.", "12.5,", "it's", "&&&", ""]
    def word():
        return rng.choice(pieces) if rng.random() < 0.5 else "".join(rng.choice("abcdeABC.,") for _ in range(rng.randint(1, 18)))
    return [rng.choice(["", " ", "\n\t"]).join(["", *[word() + rng.choice([" ", "  ", "\n", "\x0b"]) for _ in range(rng.choice([0, 1, 5, 60]))], ""]).encode() for _ in range(n)]


def test_ids_of_any_text_equal_the_tokenizers(monkeypatch):
    ids = packing.WordIds(packing.tokenizer_path(None))
    rng = random.Random(8)
    for _ in range(6):
        batch = random_texts(rng, 60)
        assert ids.encode(batch) == [reference_ids(ids, t) for t in batch]
    monkeypatch.setattr(packing, "PIECE", 50)  # a long text in pieces
    batch = random_texts(rng, 40)
    assert ids.encode(batch) == [reference_ids(ids, t) for t in batch]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    ids = packing.WordIds(packing.tokenizer_path(None))
    monkeypatch.setattr(packing, "mix", lambda z: z & np.uint64(3))
    rng = random.Random(9)
    for _ in range(3):
        batch = random_texts(rng, 30)
        assert ids.encode(batch) == [reference_ids(ids, t) for t in batch]


def test_token_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 10_000)
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)
    ids = packing.WordIds(packing.tokenizer_path(None))
    rng = random.Random(3)
    for _ in range(40):
        batch = [b" ".join(bytes(rng.choice(b"abcdefgh") for _ in range(rng.choice([5, 30]))) for _ in range(50))]
        assert ids.encode(batch) == [reference_ids(ids, batch[0])]
    assert ids.pool.nbytes < 20_000 and len(ids.h) < 1_000 and sum(map(len, ids.long)) < 10_000


def test_multikey_quicksort_equals_a_sort():
    from regscope.llm import suffix

    rng = random.Random(6)
    for alphabet, n in ((b"ab", 3_000), (b"abcdefgh", 2_000), (b"a", 300), (bytes(range(256)), 1_000), (b"xy", 1), (b"xy", 0)):
        text = bytes(rng.choice(alphabet) for _ in range(n + 60)) + b"the same phrase again and again and again " * 20 + bytes(60)
        at = np.array(rng.sample(range(len(text) - 60), min(n, len(text) - 60)), np.int64)
        words = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), 8)
        for shallow in (8, 16, 32, 48):
            order, group = suffix.multikey_quicksort(words, at, shallow)
            by = sorted(range(len(at)), key=lambda i: (text[at[i]:at[i] + shallow], i))
            held = {}
            for i in by:
                held.setdefault(text[at[i]:at[i] + shallow], []).append(i)
            want = [sorted(v) for v in held.values() if len(v) > 1]
            got = [sorted(order[group == g].tolist()) for g in range(int(group[-1]) + 1 if len(group) else 0)]
            assert got == want

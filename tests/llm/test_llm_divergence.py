"""Source divergence audit: against brute force, and its parts by themselves."""

import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))
import models as M  # noqa: E402

from regscope.llm import divergence as D  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, p long, block int, value string"
OUT = ("lang", "source", "part", "item", "value", "rank")


def rows(seed=3, n=220):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "ÄÖ", "äö", "日本", "x", "y1z", "the", "The", "o'clock", "a b", "\x00nul", "Zebra"]
    out = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s1", "s2", "s1", "S1", None, "é"]) if i % 3 else "hot"
        k = rng.choice([0, 1, 4, 30])
        out.append((i % 50, rng.choice([None, ""]) if rng.random() < 0.1 else " ".join(rng.choice(words[: 6 + (i % 9)]) for _ in range(k)), lang, source))
    out += [(None, "rare words only here", "xx", "s1"), (None, "rare words only here", "xx", "s2"), (7, None, "xx", "s3")]  # no kept term: V = 0
    out += [(9, "same text " * 3, "eq", s) for s in ("b", "a", "c") for _ in range(10)]  # equal groups: ties in value
    out += [(9, None, "eq", "empty"), (9, " \n", "eq", "empty2")]  # two groups without terms
    out += [(1, "word " * 200_000 + "Zz" * 3_000_000, "en", "hot")]  # very long, and one word of megabytes
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, t, la, s, "c", 1, 2, 3, "v") for i, t, la, s in data], SCHEMA)


def found(df):
    return Counter(tuple(r[c] for c in OUT) for r in df.collect())


@pytest.mark.parametrize("block", [D.BLOCK, 2])
def test_equals_brute_force(spark, block):
    data = rows()
    want = Counter(M.divergence([r[1:] for r in data]))
    assert found(D.divergence(spark, frame(spark, data).repartition(6), block=block)) == want
    assert any(p == "pair" and v == 0 for _, _, p, _, v, _ in want)


def test_other_parameters(spark):
    data = rows(11, 120)
    want = Counter(M.divergence([r[1:] for r in data], min_docs=3, top=2))
    assert found(D.divergence(spark, frame(spark, data), min_docs=3, top=2)) == want


def test_empty_table(spark):
    assert D.divergence(spark, frame(spark, [])).count() == 0


def test_counting_in_slices_loses_nothing(spark, monkeypatch):
    text = "Aa bb  c1c\n" * 500
    monkeypatch.setattr(D, "PIECE", 7)
    assert Counter(w for part in D.terms(text.encode()) for w in part) == Counter(x.encode() for x in M.LETTERS.findall(text.lower()))


@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_gallop_finds_the_intersection(a, b, run):
    x, y = np.array(sorted(a), np.int64), np.array(sorted(b), np.int64)
    i, j = D.gallop(x, y, run)
    assert x[i].tolist() == y[j].tolist() == sorted(a & b)


@given(st.integers(0, 10**14), st.integers(0, 10**15), st.integers(1, 10**9))
@settings(max_examples=300, deadline=None)
def test_price_is_exact(count, more, kept):
    total = count + more
    assert D.price(np.array([count]), total, kept)[0] == 1 + 1_000_000_000 * (count + 2) // (total + 2 * kept)

import random
import string
import sys
import unicodedata
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import models as M  # noqa: E402

from regscope.llm import chat, components, exact_dedup, mixing, packing, quality, sharding, simhash, substring, suffix, toxicity, words  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, pid int, size long, sha string, key string"


def corpus(seed=1, n=120):
    """Small documents that share passages, with copies, near copies, nulls,
    repeated rows, blanks of all kinds and one very long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(string.ascii_letters) for _ in range(rng.randint(1, 7))) for _ in range(400)] + ["é", "ß\u00a0x", "日本語", "#&", "the"]
    def text(k):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(k))
    passages = [text(rng.randint(15, 60)) for _ in range(4)]
    rows = []
    for i in range(n):
        t = text(rng.choice([0, 1, 2, 3, 30, 60, 120]))
        if rng.random() < 0.5:
            t += rng.choice(passages) + text(rng.randint(0, 30))
        rows.append((i * 3 + 1, t))
    rows += [(1000 + i, rows[i * 2][1]) for i in range(12)]  # copies
    rows += [(1100 + i, rows[i * 2][1].replace(" ", "\n")) for i in range(6)]  # copies but for blanks
    long = text(3000)
    rows += [(1200 + i, long + text(i)) for i in range(6)]  # near copies of a long text
    rows += [(5, long), (None, long), (None, None), (None, ""), (2000, None), (2001, ""), (2002, " \n\t"), (2003, "x"), (2003, "x"), (2003, "y"),
             (2004, "a b " * 200), (2005, "a b " * 150), (None, "only null " * 30), (None, "only null " * 30), (-7, rows[3][1]), (2006, "z" * 5000), (2007, "z" * 4000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, sources=("a", "b", "c", None)):
    return spark.createDataFrame([(d, t, "en", sources[i % len(sources)], len(t or ""), 0.5, 3, 9, "s", "k") for i, (d, t) in enumerate(rows)], SCHEMA)


def got(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return rows, frame(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# -- substring and suffix dedup ---------------------------------------------------


@pytest.mark.parametrize("unit", [4 << 20, 4_000])
def test_substring_matches_brute_force(docs, unit):
    rows, df = docs
    out = substring.substring_dedup(df, unit=unit)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(M.substring(rows))


def test_substring_other_window_and_seed(spark):
    rows = corpus(9, 60)
    out = substring.substring_dedup(frame(spark, rows), window=7, unit=3_000)
    assert got(out, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(M.substring(rows, 7))


def test_substring_repeat_inside_one_document(spark):
    w = [f"w{i}" for i in range(25)]
    out = substring.substring_dedup(frame(spark, [(1, " ".join(w + ["mid"] + w))])).first()
    assert (out["n_words"], out["n_removed"], out["n_spans"]) == (51, 25, 1)


@pytest.mark.parametrize("unit", [4 << 20, 20_000])
def test_suffix_matches_brute_force(docs, unit):
    rows, df = docs
    out = suffix.suffix_dedup(df, unit=unit)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(M.suffix(rows))


@pytest.mark.parametrize("length, gram, shallow", [(50, 24, 0), (30, 30, 8), (33, 5, 32), (16, 8, 16)])
def test_suffix_other_depths(spark, length, gram, shallow):
    rows = corpus(3, 50)
    out = suffix.suffix_dedup(frame(spark, rows), length, gram, shallow, unit=5_000)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(M.suffix(rows, length))


@pytest.mark.parametrize("hot", [0, 30])
def test_suffix_of_hot_anchors_matches_brute_force(spark, hot):
    rng = random.Random(8)
    phrase = "a phrase that a third of all of the documents have, with its end of line"
    rows = corpus(4, 40) + [(3000 + i // 2, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 9))) + phrase + rng.choice("xy") * rng.randint(0, 40)) for i in range(150)]
    out = suffix.suffix_dedup(frame(spark, rows), unit=60_000, hot=hot)
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(M.suffix(rows))


def test_suffix_segments_of_a_hot_anchor_spread():
    rng = random.Random(6)
    phrase = "a phrase that all of the documents have, each of them with other words about it"
    def text():
        return "".join(rng.choice(string.ascii_letters) for _ in range(60))
    batches = [suffix.Batch(pa.table({"pid": [p] * 100, "doc_id": list(range(100 * p, 100 * p + 100)), "text": [text() + phrase + text() for _ in range(100)]}), 50, 24) for p in range(4)]
    sent = pa.table({"p": pa.array([0] * 4, pa.int32()), "pid": pa.array(range(4), pa.int32()), "blob": pa.array([b.anchors_blob(b.kinds())(0, len(b.keys)) for b in batches], pa.binary())})
    received, whole = Counter(), 0
    for p, b in enumerate(batches):
        answers = suffix._live(40)(sent)
        answers = answers.filter(pa.compute.equal(answers["pid"], p))
        b.segments(*[suffix.answered(answers, r, np.array([0, len(b.keys)])) for r in (1, 3)])
        received.update(b.seg_hash.tolist())
        whole += int(b.seg_starts.sum())
    assert max(received.values()) <= 40 and whole > 400 * 10


def test_suffix_periodic_texts(spark):
    rows = [(1, "ab" * 60), (2, "ab" * 40 + "x"), (3, "c" * 49), (4, "c" * 49), (5, "c" * 50), (6, "c" * 51)]
    out = suffix.suffix_dedup(frame(spark, rows))
    assert got(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(M.suffix(rows))


def test_deep_shallow_order_is_suffix_order():
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(300)).encode() * 4 + bytes(rng.randrange(256) for _ in range(200))
    at = np.array(rng.sample(range(len(text) - 50), 700))
    for shallow in (0, 8, 24, 48):
        order, group = suffix.equal_suffixes(text, at, 50, shallow)
        strings = [text[at[i]:at[i] + 50] for i in order]
        assert strings == sorted(strings)
        counts = Counter(text[p:p + 50] for p in at)
        assert len(order) == sum(c for c in counts.values() if c > 1) and len(set(group.tolist())) == sum(c > 1 for c in counts.values())
        assert all((strings[i] == strings[i + 1]) == (group[i] == group[i + 1]) for i in range(len(order) - 1))


def test_blind_trie_sorts():
    rng = random.Random(2)
    tails = [bytes(rng.choice(b"\x00ab") for _ in range(9)) for _ in range(2000)]
    trie = suffix.BlindTrie()
    for i, t in enumerate(tails):
        trie.insert(t, i)
    leaves = trie.ordered()
    assert [tails[x[0]] for x in leaves] == sorted(set(tails)) and sorted(i for x in leaves for i in x) == list(range(2000))


# -- exact dedup --------------------------------------------------------------------


def test_binary_fuse_has_no_false_negative():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 100, 1000, 30_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        f = exact_dedup.BinaryFuse.build(keys)
        assert not n or f.contains(keys).all()
        other = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        assert f.contains(other).mean() < 0.001
    assert f.cells.nbytes < 2.6 * 30_000


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_exact_dedup_matches_brute_force(spark, docs, parts):
    rows, df = docs
    out = exact_dedup.exact_dedup(spark, exact_dedup.split_batches(df, parts), bucket_rows=20).cache()
    want, groups = M.exact(rows)
    assert got(out, "doc_id", "keep_id", "group_size", "text_sha256") == Counter(want)
    kept = out.filter("kept")
    assert kept.count() == groups and kept.filter("not doc_id <=> keep_id").isEmpty()
    assert kept.select("text_sha256").distinct().count() == groups


def test_screen_passes_only_known_digests(spark):
    old = spark.range(5000).select(F.xxhash64("id").alias("h"))
    new = spark.range(2500, 7500).select(F.xxhash64("id").alias("h"), "id")
    hits = exact_dedup.screen(new, exact_dedup.build_filters(old, 7), 7)
    ids = {r["id"] for r in hits.collect()}
    assert set(range(2500, 5000)) <= ids and len(ids) < 2520


# -- mixing --------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows", [1000, 7])
def test_mix(spark, docs, shard_rows):
    rows, df = docs
    out = mixing.mix(df, shard_rows=shard_rows).collect()
    sizes = Counter()
    for r in out:
        sizes[r["source"]] += r["size"]
    want = M.mix_targets(dict(sizes))
    assert len(out) == len(rows) and Counter(r["size"] for r in out) == Counter(len(M.words(t)) for _, t in rows)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    shards = {(r["source"], r["shard"]) for r in out}
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK * (1 + sum(1 for x, _ in shards if x == s)), s
    again = mixing.mix(df.repartition(3), shard_rows=shard_rows)
    assert got(again, "doc_id", "size", "taken") == Counter((r["doc_id"], r["size"], r["taken"]) for r in out)


def test_apportion_is_highest_quotients(spark):
    rng = random.Random(4)
    for trial in range(4):
        claims = [(f"c{i}", rng.choice([0.0, 1.0, 5.0, 7.5, 100.0, 33.3]) * rng.random(), rng.randint(0, 60)) for i in range(9)]
        seats = rng.randint(0, 40)
        df = spark.createDataFrame([("x", n, c, k, seats) for n, c, k in claims], "g string, n string, c double, k long, s long")
        out = {r["n"]: r["won"] for r in mixing.apportion(df, "s", "c", "k", "won", ["g"], ["n"]).collect()}
        if all(k >= 60 for _, _, k in claims) or trial == 0:
            quotients = sorted(((-c / (2 * i + 1), n) for n, c, _ in claims if c for i in range(60)))[:seats]
            if all(k > sum(1 for _, x in quotients if x == n) for n, _, k in claims):
                assert out == {n: sum(1 for _, x in quotients if x == n) for n, _, _ in claims}
        assert all(out[n] <= k for n, _, k in claims)


@pytest.mark.parametrize("seats", range(0, 14))
def test_apportion_resolves_ties_by_name(spark, seats):
    claims = {"a": 5.0, "b": 5.0, "c": 5.0, "d": 15.0, None: 5.0}
    df = spark.createDataFrame([("x", n, c, 99, seats) for n, c in claims.items()], "g string, n string, c double, k long, s long")
    out = {r["n"]: r["won"] for r in mixing.apportion(df, "s", "c", "k", "won", ["g"], ["n"]).collect()}
    listed = sorted((-c / (2 * i + 1), n is None, n or "", i) for n, c in claims.items() for i in range(20))[:seats]
    assert out == {n: sum(1 for _, no, x, _ in listed if (None if no else x) == n) for n in claims}


def test_mixed_documents_take_effect(spark, docs):
    rows, df = docs
    taken = mixing.mix(df).agg(F.sum("taken")).first()[0]
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    texts = [r["text"] for r in out.collect()]
    assert sum(len(M.words(t)) for t in texts) == taken
    whole = {t for _, t in rows}
    assert sum(t not in whole for t in texts) <= 8  # at most one cut document a shard and pass


# -- packing -------------------------------------------------------------------------


def pieces_fit(out, limits):
    for seq in out:
        assert sum(n for _, _, n in seq) <= limits[0] and len(seq) <= limits[1]


def test_pack_limits_hold_together():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1, 900, 400)
    loss = (tokens * rng.random(400)).astype(int)
    out = packing.pack(tokens, loss, max_tokens=1024, max_segments=6, max_loss=500, min_cut=16)
    pieces_fit(out, (1024, 6))
    seen = {}
    for seq in out:
        lost = 0
        for i, s, n in seq:
            seen.setdefault(i, []).append((s, n))
            lost += max(0, s + n - max(s, tokens[i] - loss[i]))
        assert lost <= 500
    for i, t in enumerate(tokens):
        at = 0
        for s, n in sorted(seen[i]):
            assert s == at
            at += n
        assert at == t


def test_pack_documents(spark, docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    rows, df = docs
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    ids_of = {}
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[(d, len(ids))] += 1
        ids_of.setdefault((d, len(ids)), []).append(ids)
    out = packing.pack_documents(df, unit=20_000).collect()
    assert Counter({k: v for k, v in Counter((r["doc_id"], r["doc_tokens"]) for r in out if r["start"] == 0).items()}) == want
    for r in out:
        assert any(zlib.crc32(i[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for i in ids_of[(r["doc_id"], r["doc_tokens"])])
    assert sum(r["length"] for r in out) == sum(k * v for (_, k), v in want.items())
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.01 * sum(r["length"] for r in out)


def test_pack_documents_under_a_loss_limit(spark):
    rows = [(i, "word " * (20 + i % 30)) for i in range(300)]
    df = frame(spark, rows).withColumn("answer", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 12))
    out = packing.pack_documents(df, max_tokens=256, max_loss=40, unit=4_000, loss_col="answer").collect()
    lost, pieces = Counter(), {}
    for r in out:
        loss = min(r["doc_tokens"], r["doc_id"] % 12) if r["doc_id"] % 7 else r["doc_tokens"]
        lost[r["sequence_id"]] += max(0, r["start"] + r["length"] - max(r["start"], r["doc_tokens"] - loss))
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    assert max(lost.values()) <= 40 and len(pieces) == 300
    for (_, tokens), parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == tokens


# -- sharding ------------------------------------------------------------------------


def test_difference_is_tight_and_whole():
    rng = np.random.default_rng(0)
    sums = np.zeros((500, 8), np.int64)
    sums[:, 0] = rng.integers(1, 100_000, 500)
    final, places = sharding.difference(sums)
    again = np.zeros(8, np.int64)
    np.add.at(again, places.ravel(), sums.ravel())
    assert (np.sort(places, axis=1) == np.arange(8)).all()
    assert sorted(again) == sorted(final) and final.max() - final.min() < 100


@pytest.mark.parametrize("fan_in", [20_000, 11])
def test_sharding(spark, docs, fan_in):
    rows, df = docs
    out = sharding.shard_by_bytes(spark, df, fan_in=fan_in, rank_rows=13).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    home, sums, slots = {}, Counter(), {}
    for r in out:
        assert home.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"] and 0 <= r["shard"] < 8
        assert r["law"] == "bytes" and r["grown_shard"] is None
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(sums.values()) <= max(max(groups.values()), sum(groups.values()) / 8) + 60


# -- SimHash --------------------------------------------------------------------------


def test_copies_of_one_text_are_ranked_in_slices(spark):
    out = sharding.shard_by_bytes(spark, frame(spark, [(i, "the same text") for i in range(400)]), rank_rows=20).collect()
    at = [r["doc_id"] for r in sorted(out, key=lambda r: r["slot"])]
    assert sorted(r["slot"] for r in out) == list(range(400)) and sorted(at) == list(range(400))
    runs = np.diff(np.flatnonzero([True, *[a > b for a, b in zip(at, at[1:])], True]))  # ids ascend within a slice
    assert runs.max() <= 40


def test_golay_keys_cover_three_errors():
    rng = random.Random(11)
    _, errors, count = simhash.golay_tables()
    assert sorted(set(count.tolist())) == [1, 6] and len(errors) == 2048
    x = [rng.getrandbits(64) for _ in range(3000)]
    y = []
    for v in x:
        for b in rng.sample(range(64), rng.randint(1, 3)):
            v ^= 1 << b
        y.append(v)
    filed, looked = {}, {}
    for into, fps, probe in ((filed, x, False), (looked, y, True)):
        for row, key in zip(*(a.tolist() for a in simhash.keys(np.array(fps, np.uint64), probe)), strict=True):
            into.setdefault(row, set()).add(key)
    assert all(filed[i] & looked[i] for i in range(3000))


def test_near_duplicates(spark, docs):
    rows, df = docs
    want, groups = M.components(rows)
    out = simhash.near_duplicates(spark, df).cache()
    assert got(out, "doc_id", "fingerprint", "component_id") == Counter(want)
    assert simhash.representatives(out).count() == groups


def test_links_find_every_pair(spark):
    rng = random.Random(8)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(6):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 4)):
                y ^= 1 << b
            fps.add(y - (1 << 64) if y >> 63 else y)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for distance in (0, 2, 3):
        want = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        assert {tuple(r) for r in simhash.links(df, distance).collect()} == want


def test_keys_of_fingerprints_are_never_broadcast(spark, scratch):
    # small files: by their size alone the planner would broadcast tables of many more rows
    rng = random.Random(9)
    fps = [rng.getrandbits(63) for _ in range(200)]
    spark.createDataFrame([(f ^ e, i) for i, f in enumerate(fps) for e in (0, 5)], "fp long, least long").write.parquet(f"{scratch}/nodes")
    found = simhash.links(spark.read.parquet(f"{scratch}/nodes"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == {(min(f, f ^ 5), max(f, f ^ 5)) for f in fps}
    spark.createDataFrame([(i, f"word{i} alike") for i in range(40)] * 2, "doc_id long, text string").write.parquet(f"{scratch}/docs")
    out = simhash.near_duplicates(spark, spark.read.parquet(f"{scratch}/docs"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 80 and out.select("component_id").distinct().count() == 40


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    out = {r["node"]: r["component"] for r in components.connected_components(spark, df).collect()}
    assert out == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 260)}}


# -- quality rules ----------------------------------------------------------------------


def test_quality_counts(spark, docs):
    rows, df = docs
    out = quality.quality_rules(spark, df)
    want = Counter()
    for d, t in rows:
        c = M.base_counts(t)
        want[(d, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want


def test_recurring_lines_deplete(spark):
    own = [" ".join(f"d{i}w{j}" for j in range(60)) for i in range(30)]
    common = " ".join(f"c{j}" for j in range(100))
    rows = [(i, f"{t}\n  {common.upper()} ") for i, t in enumerate(own)] + [(100 + i, f"{t}\nshort line") for i, t in enumerate(own)] \
        + [(200, " ".join(f"k{j}" for j in range(80)))] + [(300 + i, " ".join(f"k{j}" for j in range(80))) for i in range(40)]
    out = {r["doc_id"]: r for r in quality.quality_rules(spark, frame(spark, rows, ("one",))).collect()}
    assert all(not out[i]["kept"] and out[i]["removed_words"] == 100 for i in range(30))  # 60 of 160 words are left
    assert all(out[100 + i]["kept"] and out[100 + i]["removed_words"] == 2 for i in range(30))
    assert out[200]["kept"] and out[310]["kept"]  # copies are one document
    two = {r["doc_id"]: r for r in quality.quality_rules(spark, frame(spark, rows, ("one", "two"))).collect()}
    assert all(two[i]["kept"] and two[i]["removed_words"] == 0 for i in range(30))  # at most 15 a host


# -- toxicity -----------------------------------------------------------------------------


def toxic_rows(n=600):
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        kind = i % 6
        if kind in (0, 1):
            w.insert(rng.randrange(len(w)), "insult,")
        if kind in (0, 2):
            w.insert(rng.randrange(len(w)), "Group")
        rows.append((i, " ".join(w)))
        labels.append((i, int(kind == 0)))  # only both together are toxic
    return rows, labels


def test_factorization_machine_learns_a_pair(spark):
    rows, labels = toxic_rows()
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    out = toxicity.toxicity(spark, frame(spark, rows), lab).collect()
    truth = dict(labels)
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out) and len(held) > 100
    wrong = [r for r in held if r["predicted"] != truth[r["doc_id"]]]
    assert len(wrong) <= 0.03 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_scores_need_no_labels_and_any_text(spark, docs):
    rows, df = docs
    out = toxicity.toxicity(spark, df, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len(out) == len(rows) and len({r["score"] for r in out}) == 1
    m = toxicity.train(spark, df, spark.createDataFrame([], "doc_id long, toxic int"))
    scored = toxicity.score(spark, df, m, "__score")
    assert scored.columns == [*df.columns, "__score"] and scored.count() == len(rows)


# -- chat -----------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    hard = ["", None, "\\", "\\\\n", "<", "</s>", "<\\/s>", "[INST]", "[/INST] x </s>[ROLE a] b [/ROLE]", "[", "]", "é\n日", " lead", "trail ", "[/INST", "\\</s>\\", "$1 \\1"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "a]b[c<\\", "x y", "\\c"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(roles), rng.choice(hard)) for c in [*range(40), None] for t in range(rng.randint(1, 12))]
    rows += [(500, 0, "user", "same turn b"), (500, 0, "user", "same turn a"), (500, None, "assistant", "null turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(df)).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert out.keys() == by.keys()
    for c, turns in by.items():
        turns = sorted(turns, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:]))
        all_ = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        lost = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        assert (out[c]["n_turns"], out[c]["turns_sha256"], out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(turns), M.sha(all_), len(lost), M.sha(lost)), c


def test_machine_validates_order(spark):
    def conv(i, *roles):
        return [(i, t, r, "x") for t, r in enumerate(roles)]
    rows = conv(1, "user", "assistant") + conv(2, "system", "user", "tool", "assistant") + conv(3, "assistant", "user") + conv(4, "user", "user", "assistant") \
        + conv(5, "user") + conv(6, "user", "robot", "assistant")
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    f = chat.format_conversations(df)
    assert {r["conv_id"]: r["valid"] for r in f.collect()} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False}
    one = f.filter("conv_id = 1").first()
    assert one["formatted"] == "[INST] x [/INST]<s> x </s>" and [(s["text"], s["loss"]) for s in one["segments"]][4] == ("x", True)
    assert sum(s["loss"] for s in one["segments"]) == 1


def test_no_python_on_the_native_path(docs, spark):
    _, df = docs
    plans = [mixing.mix(df), mixing.mixed_documents(df),
             chat.digest(chat.format_conversations(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")))]
    for p in plans:
        text = p._jdf.queryExecution().executedPlan().toString()
        assert not any(x in text for x in ("Python", "Arrow", "Pandas"))


# -- all ----------------------------------------------------------------------------------


def test_empty_tables(spark, none):
    e = spark.createDataFrame([], "doc_id long, toxic int")
    outs = [substring.substring_dedup(none), suffix.suffix_dedup(none), exact_dedup.exact_dedup(spark, exact_dedup.split_batches(none)), mixing.mix(none),
            mixing.mixed_documents(none), packing.pack_documents(none), sharding.shard_by_bytes(spark, none), toxicity.toxicity(spark, none, e),
            simhash.near_duplicates(spark, none), quality.quality_rules(spark, none),
            chat.digest(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))]
    assert [o.count() for o in outs] == [0] * len(outs)


def test_rolling_hash_equals_its_definition():
    h = np.random.default_rng(1).integers(0, 1 << 63, 200, dtype=np.uint64)
    base = int(words.BASE)
    for n in (1, 2, 3, 7, 10, 20, 24):
        want = [sum(int(x) * pow(base, n - 1 - k, 1 << 64) for k, x in enumerate(h[i:i + n])) % (1 << 64) for i in range(len(h) - n + 1)]
        assert words.rolling(h, n).tolist() == words.mix(np.array(want, np.uint64)).tolist()
    assert len(words.rolling(h[:3], 4)) == 0


def test_word_ids_equal_the_tokenizers():
    ids = packing.word_ids(None)
    texts = ["Hello, WORLD.. it's I'LL a!. x., 12.5, ...", "Σας ΣΑΣ. café, <|endoftext|>x   ǅ. İstanbul ß\u0085q \x1cẛ̣. ét日本,語.", "", " \n ", "a" * 3000 + ".",
             "don't. can't, 's. ,a .b ..c.. ñandú, ŉ. ﬁn."]
    got = ids.encode([t.encode() for t in texts])
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


def test_word_ids_of_letters_that_normalize_to_a_mark():
    ids = packing.word_ids(None)
    alone = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    marked = [c for c in alone if not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert {"\u0130", "\u0958", "\u09df", "\u0a33", "\ufb1d", "\ufb4e"} <= set(marked)
    texts = ["EV\u0130. \u0130. \u09df, x\u09df. \u0130 \u0130,."] + [f"{c}. a{c}., {c}" for c in marked]
    for t, g in zip(texts, ids.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(g, "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


def test_long_texts_are_counted_in_pieces(monkeypatch):
    rng = random.Random(4)
    held = [b" ".join(rng.choice([b"a", b"Bb", b"c"]) + str(rng.randint(0, 20)).encode() for _ in range(n)) for n in (3, 40, 41, 42, 43, 44, 500)]
    want = simhash.fingerprints_of(held).tolist()
    monkeypatch.setattr(simhash, "LONG", 40)
    assert simhash.fingerprints_of(held).tolist() == want == [M.fingerprint(t.decode()) for t in held]


def test_a_repeated_labelled_id_counts_once(spark):
    rows, labels = toxic_rows(300)
    labelled = next(d for d, y in labels if y and zlib.crc32(str(d).encode()) % 4 != 2)
    again = frame(spark, [*rows, *[(labelled, f"other text {i}") for i in range(50)]])
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    one, two = toxicity.train(spark, again, lab), toxicity.train(spark, again.repartition(7), lab)
    assert one.bias == two.bias and (one.weight == two.weight).all()

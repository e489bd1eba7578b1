"""Exact dedup over kept snapshots: a later run goes on from folders that never change."""

import hashlib
import os
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import models as M  # noqa: E402
from test_llm_operators import corpus, frame  # noqa: E402

from regscope.llm import exact_dedup as E  # noqa: E402

OUT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def listing(folder):
    """Every file below a folder, and what is in it."""
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(folder).rglob("*") if p.is_file()}


def found(df):
    return Counter(tuple(r[c] for c in OUT) for r in df.collect())


def test_a_later_run_goes_on_from_kept_snapshots(spark, scratch, monkeypatch):
    rows = corpus(8, 60)
    parts = [frame(spark, rows[i::3]).cache() for i in range(3)]
    whole, _ = E.deduplicate(spark, parts, bucket_rows=20)
    built = []
    own = E.build_filters
    monkeypatch.setattr(E, "build_filters", lambda exact, buckets: built.append(buckets) or own(exact, buckets))
    first, snapshots = E.deduplicate(spark, parts[:2], bucket_rows=20, folder=f"{scratch}/kept")
    before = listing(f"{scratch}/kept")
    assert len(snapshots) == 2 and len(built) == 2 and first.count() == len(rows[0::3]) + len(rows[1::3])
    again = [E.open_snapshot(spark, f"{scratch}/kept/batch-{i}") for i in range(2)]
    assert again == snapshots
    last, every = E.deduplicate(spark, parts[2:], bucket_rows=20, earlier=again)
    want, got = found(whole), found(last)
    assert got <= want and sum(got.values()) == len(rows[2::3])
    assert listing(f"{scratch}/kept") == before and len(built) == 2 and len(every) == 3  # nothing rebuilt, nothing changed
    kept = Counter(t for r in (first, last) for *_, k, t in found(r) if k)
    assert set(kept.values()) == {1} and len(kept) == len({M.sha(" ".join(x)) for x in kept}) and len(kept) == M.exact(rows)[1]


def test_snapshots_of_empty_batches(spark, scratch):
    none = frame(spark, [])
    out, snapshots = E.deduplicate(spark, [none, frame(spark, [(1, "a"), (2, "a")]), none], folder=f"{scratch}/k")
    assert found(out) == Counter({(1, 1, 2, True, M.sha("a")): 1, (2, 1, 2, False, M.sha("a")): 1}) and len(snapshots) == 3
    more, _ = E.deduplicate(spark, [frame(spark, [(0, "a"), (None, None)])], earlier=snapshots)
    assert found(more) == Counter({(0, 1, 3, False, M.sha("a")): 1, (None, None, 1, True, M.sha("")): 1})
    with pytest.raises(ValueError):
        E.deduplicate(spark, [])
    assert os.path.isdir(f"{scratch}/k/batch-0/filters")

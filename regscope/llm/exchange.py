"""Two-way exchange between batches of documents and ranges of hashed keys.

A batch (``pid``) hashes what its documents hold, sends each distinct key once to
the key's range, and gets one bit back for each key it sent, in the order sent. A
key held by a third of all documents is thus one entry per batch, however often
it occurs, and no range receives more than that. Batches and ranges are of
bounded size, see ``common.batch_plan``.

A batch is recomputed in each round rather than kept: its rows, sorted, are the
same every time, so the order of its keys is too, and any task can be run again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SENT = "p int, pid int, blob binary"
ANSWER = "pid int, round int, p int, blob binary"

#: Rank of a null id: after every other.
LAST = np.iinfo(np.int64).max


def sorted_rows(table: pa.Table) -> pa.Table:
    """A batch's rows by id (null last), then text: the order of "earlier"."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def ids(table: pa.Table) -> np.ndarray:
    return table["doc_id"].combine_chunks().fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the n key ranges within sorted 64-bit keys, by their upper half."""
    upper = (np.arange(1, n, dtype=np.uint64) << np.uint64(32)) // np.uint64(n)
    return np.concatenate([[0], np.searchsorted(keys >> np.uint64(32), upper, side="left"), [len(keys)]])


def send(pid: int, bounds: np.ndarray, blob) -> pa.Table:
    """One row per range that has keys; ``blob(i, j)`` packs the i-th to j-th key."""
    p = np.flatnonzero(bounds[1:] > bounds[:-1])
    return pa.table({"p": pa.array(p, pa.int32()), "pid": pa.array([pid] * len(p), pa.int32()),
                     "blob": pa.array([blob(int(bounds[k]), int(bounds[k + 1])) for k in p], pa.binary())})


def answer(table: pa.Table, round_: int, bits: np.ndarray, counts: np.ndarray) -> pa.Table:
    """A range's answer: ``bits`` holds one for each key, batch by batch."""
    ends = np.cumsum(counts)
    blobs = [np.packbits(bits[e - c:e]).tobytes() for e, c in zip(ends, counts, strict=True)]
    n = len(blobs)
    return pa.table({"pid": table["pid"].cast(pa.int32()), "round": pa.array([round_] * n, pa.int32()),
                     "p": table["p"].cast(pa.int32()), "blob": pa.array(blobs, pa.binary())})


def answered(table: pa.Table, round_: int, bounds: np.ndarray) -> np.ndarray:
    """The bits of one round for all keys sent, in the order sent."""
    out = np.zeros(int(bounds[-1]), bool)
    for r, p, blob in zip(table["round"].to_pylist(), table["p"].to_pylist(), table["blob"].to_pylist(), strict=True):
        if r == round_:
            i, j = int(bounds[p]), int(bounds[p + 1])
            out[i:j] = np.unpackbits(np.frombuffer(blob, np.uint8), count=j - i).astype(bool)
    return out

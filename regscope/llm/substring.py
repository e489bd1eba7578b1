"""Substring deduplication by fixed-block anchors.

Of every repeated run of ``window`` (20) words, all occurrences but the first
(smallest id, then earliest start) lose their words. Index: every document is cut
in non-overlapping blocks of ``window // 2`` words, so any window holds a whole
block, wherever it starts. Probe: each document's every rolling block-length run
is looked up. A run is an anchor if some document has it as a block and it occurs
elsewhere as well. Hits are extended to both sides: every window around an anchor
is hashed in full, and equal ones are matched to their first occurrence.
Overlapping matched windows are the maximal exact repeats, whose words go.

Round 1 of the exchange sends block hashes and gets anchors, round 2 sends the
hashes of windows around anchors and gets which are first occurrences. Window
hashes have 96 bits.

Words are split at ASCII blanks alone. Null text has no words. Rows of null id
come last; rows that repeat an id have a fixed order among themselves (by batch,
then text), in which the first is the earlier one. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regscope.llm.common import batch_plan, text_bytes, with_batch
from regscope.llm.exchange import ANSWER, SENT, answer, answered, ids, ranges, send, sorted_rows
from regscope.llm.words import hashes, mix, rolling, texts

WINDOW = 20
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long"


class Batch:
    """Words of a batch's documents, one after the other, and their hashes."""

    def __init__(self, table: pa.Table, window: int):
        self.table = sorted_rows(table)
        self.window, self.block = window, max(1, window // 2)
        self.words = [t.split() for t in texts(self.table["text"])]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.total = int(self.counts.sum())
        self.doc = np.repeat(np.arange(len(self.words)), self.counts)
        self.h = hashes([x for w in self.words for x in w])
        run = rolling(self.h, self.block)
        self.runs = np.flatnonzero(self.doc[:len(run)] == self.doc[self.block - 1:]) if len(run) else np.empty(0, np.int64)
        # distinct runs: whether one is a block, and whether it occurs twice
        self.keys, self.of, count = np.unique(run[self.runs], return_inverse=True, return_counts=True)
        first = np.cumsum(self.counts) - self.counts
        aligned = (self.runs - first[self.doc[self.runs]]) % self.block == 0
        self.blocks = np.zeros(len(self.keys), bool)
        self.blocks[self.of[aligned]] = True
        self.twice = count > 1

    def runs_blob(self, i: int, j: int) -> bytes:
        low = (self.keys[i:j] & np.uint64(0x3FFFFFFF)).astype(np.uint32)
        return (low << 2 | self.blocks[i:j].astype(np.uint32) << 1 | self.twice[i:j]).astype("<u4").tobytes()

    def windows(self, anchors: np.ndarray) -> None:
        """Distinct windows around anchors (a bit per distinct run), in key order."""
        held = np.zeros(self.total + 1, np.int64)
        held[self.runs + 1] = anchors[self.of]
        held = np.cumsum(held)  # anchors before each word
        w, span = self.window, self.window - self.block + 1
        n = max(0, self.total - w + 1)
        at = np.flatnonzero((self.doc[:n] == self.doc[w - 1:]) & (held[span:span + n] > held[:n])) if n else np.empty(0, np.int64)
        full = rolling(self.h, w)[at]
        self.at = at
        self.wkeys, self.wfirst, self.wof = np.unique(full, return_index=True, return_inverse=True)
        second = rolling(mix(self.h ^ _SECOND), w, _SECOND)[at[self.wfirst]] if len(at) else np.empty(0, np.uint64)
        self.wsecond = (second >> np.uint64(32)).astype(np.uint32)
        self.wdoc = ids(self.table)[self.doc[at[self.wfirst]]] if len(at) else np.empty(0, np.int64)

    def windows_blob(self, i: int, j: int) -> bytes:
        return self.wkeys[i:j].astype("<u8").tobytes() + self.wdoc[i:j].astype("<i8").tobytes() + self.wsecond[i:j].astype("<u4").tobytes()

    def result(self, first_here: np.ndarray) -> pa.Table:
        """first_here: for each distinct window, whether its first occurrence of
        all is this batch's first."""
        gone = np.ones(len(self.at), bool)
        gone[self.wfirst[first_here]] = False
        edge = np.zeros(self.total + 1, np.int64)
        np.add.at(edge, self.at[gone], 1)
        np.add.at(edge, self.at[gone] + self.window, -1)
        removed = np.cumsum(edge[:-1]) > 0
        n_removed = np.bincount(self.doc, weights=removed, minlength=len(self.words)).astype(np.int64)
        starts = removed.copy()
        starts[1:] &= ~removed[:-1] | (self.doc[1:] != self.doc[:-1])
        spans = np.bincount(self.doc, weights=starts, minlength=len(self.words)).astype(np.int64)
        digests, at = [], 0
        for words, n in zip(self.words, n_removed.tolist(), strict=True):
            kept = compress(words, (~removed[at:at + len(words)]).tolist()) if n else words
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            at += len(words)
        return pa.table({"doc_id": self.table["doc_id"], "n_words": self.counts, "n_removed": n_removed, "kept_sha256": digests, "n_spans": spans})


def _anchors(table: pa.Table) -> pa.Table:
    table = table.sort_by("pid")
    parts = [np.frombuffer(b, "<u4") for b in table["blob"].to_pylist()]
    every = np.concatenate(parts)
    keys, of = np.unique(every >> 2, return_inverse=True)
    block = np.bincount(of, weights=every >> 1 & 1, minlength=len(keys)) > 0
    seen = np.bincount(of, weights=1 + (every & 1).astype(np.int64), minlength=len(keys)) > 1
    return answer(table, 1, (block & seen)[of], np.array([len(p) for p in parts]))


def _firsts(table: pa.Table) -> pa.Table:
    table = table.sort_by("pid")
    blobs = table["blob"].to_pylist()
    counts = np.array([len(b) // 20 for b in blobs])
    key = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, counts, strict=True)])
    doc = np.concatenate([np.frombuffer(b, "<i8", n, 8 * n) for b, n in zip(blobs, counts, strict=True)])
    second = np.concatenate([np.frombuffer(b, "<u4", n, 16 * n) for b, n in zip(blobs, counts, strict=True)])
    batch = np.repeat(np.arange(len(blobs)), counts)
    order = np.lexsort((batch, doc, second, key))
    k, s = key[order], second[order]
    first = np.ones(len(order), bool)
    first[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    bits = np.empty(len(order), bool)
    bits[order] = first
    return answer(table, 2, bits, counts)


def substring_dedup(docs: DataFrame, window: int = WINDOW, unit: int = 4 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, n_spans
    (maximal repeats removed)."""
    if window < 2:
        raise ValueError("a window has at least two words")
    n, ranges_n = batch_plan(text_bytes(docs), unit)
    batches = with_batch(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), n, ["doc_id", "text"])

    def probe(table: pa.Table) -> pa.Table:
        b = Batch(table, window)
        return send(table["pid"][0].as_py(), ranges(b.keys, ranges_n), b.runs_blob)

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"p": pa.array([], pa.int32()), "pid": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        b = Batch(table, window)
        b.windows(answered(answers, 1, ranges(b.keys, ranges_n)))
        return send(table["pid"][0].as_py(), ranges(b.wkeys, ranges_n), b.windows_blob)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(table, window)
        b.windows(answered(answers, 1, ranges(b.keys, ranges_n)))
        return b.result(answered(answers, 2, ranges(b.wkeys, ranges_n)))

    anchors = batches.groupBy("pid").applyInArrow(probe, SENT).groupBy("p").applyInArrow(_anchors, ANSWER)
    firsts = batches.groupBy("pid").cogroup(anchors.groupBy("pid")).applyInArrow(extend, SENT).groupBy("p").applyInArrow(_firsts, ANSWER)
    return batches.groupBy("pid").cogroup(anchors.unionByName(firsts).groupBy("pid")).applyInArrow(remove, RESULT)

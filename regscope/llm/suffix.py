"""Byte-level deduplication by a sparse suffix array, sorted deep-shallow.

A byte goes when a ``length`` (50) byte string that covers it also starts in a
document of smaller id. Only strings that can repeat are sorted:

1. Each string is represented by an anchor, the ``gram``-byte run in it of
   smallest hash (the first of equal ones); neighbouring strings mostly share
   theirs, and equal strings have equal anchors in equal places. Batches exchange
   the anchors' hashes; an anchor is live when two documents have it.
2. The strings of a live anchor in one place form a segment: consecutive starts,
   one stretch of text. Batches send each distinct segment to its anchor's range.
   There, equal segments are joined, and for anchors with more than one kind of
   segment all suffixes that start a string are sorted, ``length`` bytes deep:
   by multikey quicksort down to a shallow depth, eight bytes a key and all groups
   of one level at a time; then each group that still shares its prefix goes
   through a blind trie. Suffixes equal to the full depth are neighbours: the
   smallest id among them stays.

At both edges of a frequent phrase each document has a segment of its own, all of
one anchor. In round 1 batches also tell how many kinds of segment their frequent
anchors have. An anchor with more than ``hot`` of them (or four a batch, if that is
more) is hot: each of its strings, distinct in a batch, is a segment of its own and
goes to the range of its own hash, so that they spread and equal ones still meet.

Matches lie within documents by construction. Texts are UTF-8 bytes; null is
empty. A null id ranks last, equal to other null ids; rows that repeat an id do
not remove each other's bytes. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from regscope.llm.common import batch_plan, text_bytes, with_batch
from regscope.llm.exchange import ANSWER, SENT, answer, answered, ids, ranges, send, sorted_rows
from regscope.llm.words import mix, rolling, texts

LENGTH = 50
GRAM = 24
SHALLOW = 32
#: Kinds of segment of one anchor that one range may receive, about 2 MB.
HOT = 20_000
#: Kinds of segment up to which a batch does not count them.
FEW = 4

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_UPPER = np.uint64(0xFFFFFFFF00000000)
_LOWER = np.uint64(0xFFFFFFFF)


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray] | None:
    """(hash of the anchor, first start) of each run of starts that share an anchor."""
    n = len(text) - length + 1
    if n <= 0:
        return None
    h = rolling(np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1), gram)
    low = (h & _UPPER) | np.arange(len(h), dtype=np.uint64)  # least hash, then least place
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    at = (np.minimum(low[:n], low[rest:rest + n]) & _LOWER).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    # least hashes are small numbers: mixed again, they fall evenly into the key ranges
    return mix(h[at[start]] + np.uint64(1)), start


class BlindTrie:
    """Strings of one length in order, equal ones at one leaf. A node knows only
    the place where its strings first differ; an insertion goes down by those
    bytes alone and compares one string in full."""

    __slots__ = ("root", "leaves")

    def __init__(self) -> None:
        self.root: object = None
        self.leaves: dict[bytes, list[int]] = {}

    def insert(self, tail: bytes, item: int) -> None:
        leaf = self.leaves.get(tail)
        if leaf is not None:
            leaf.append(item)
            return
        self.leaves[tail] = [item]
        if self.root is None:
            self.root = tail
            return
        node = self.root  # blindly down to any leaf of the path
        while not isinstance(node, bytes):
            place, kids = node
            node = kids.get(tail[place]) or next(iter(kids.values()))
        differs = next(i for i, (a, b) in enumerate(zip(tail, node, strict=True)) if a != b)
        old = node[differs]
        # where on the path the new branch belongs
        parent, node = None, self.root
        while not isinstance(node, bytes) and node[0] < differs:
            parent, node = node, node[1][tail[node[0]]]
        if not isinstance(node, bytes) and node[0] == differs:
            node[1][tail[differs]] = tail
            return
        branch = (differs, {old: node, tail[differs]: tail})
        if parent is None:
            self.root = branch
        else:
            parent[1][tail[parent[0]]] = branch

    def ordered(self) -> list[list[int]]:
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                out.append(self.leaves[node])
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        return out


def multikey_quicksort(words: np.ndarray, at: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort suffixes that begin at ``at`` by their first ``shallow`` bytes. ``words``:
    the eight bytes that begin at each place. Each group of suffixes is partitioned
    around a pivot key (the median of its first, middle and last) into less, equal and
    greater: the outer parts go on with the same key, the middle one with the next
    eight bytes. Returns (order, group in that order) of suffixes that share all
    ``shallow`` bytes with another."""
    order, place = np.arange(len(at)), np.arange(len(at))  # place: where in ``order`` the suffixes at work are
    group, depth = np.zeros(len(at), np.int64), np.zeros(1, np.int64)
    if not shallow:
        return order, group
    shared: list[np.ndarray] = []
    begins = np.zeros(1, np.int64)  # of each group, among the suffixes at work
    while len(place):
        key = np.ascontiguousarray(words[at[order[place]] + depth[group]]).view(">u8").ravel().astype(np.uint64)
        size = np.diff(np.append(begins, len(place)))
        x, y, z = key[begins], key[begins + size // 2], key[begins + size - 1]
        pivot = np.maximum(np.minimum(x, y), np.minimum(np.maximum(x, y), z))[group]
        side = (key > pivot).astype(np.int64) + (key >= pivot)
        count = np.bincount(group * 3 + side, minlength=3 * len(begins))
        start = np.cumsum(count) - count
        old = order[place]
        for c in range(3):  # members of a part keep their order
            own = np.flatnonzero(side == c)
            n = count[c::3]
            rank = np.arange(len(own)) - (np.cumsum(n) - n)[group[own]]
            order[place[start[3 * group[own] + c] + rank]] = old[own]
        part = np.arange(len(count))
        deeper = depth[part // 3] + 8 * (part % 3 == 1)
        done = (deeper == shallow) & (count > 1)
        todo = (count > 1) & ~done
        of = np.repeat(part, count)
        shared += np.split(place[done[of]], np.cumsum(count[done])[:-1]) if done.any() else []
        place, number = place[todo[of]], np.cumsum(todo) - 1
        group, depth, size = number[of[todo[of]]], deeper[todo], count[todo]
        begins = np.cumsum(size) - size
    shared.sort(key=lambda p: p[0])
    if not shared:
        return order[:0], order[:0]
    return order[np.concatenate(shared)], np.repeat(np.arange(len(shared)), [len(p) for p in shared])


def equal_suffixes(text: bytes, at: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes of ``text`` at ``at``, ``length`` bytes deep. Returns
    (order, group of each in that order) of those that are not alone; equal
    strings have one group, and groups are numbered in order."""
    data = np.frombuffer(text + bytes(8), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    shallow = min(shallow, length) // 8 * 8
    order, group = multikey_quicksort(words, at, shallow)
    if shallow == length or not len(order):
        return order, group
    out, out_group, number = [], [], 0
    bounds = np.flatnonzero(np.append(np.append(True, group[1:] != group[:-1]), True)).tolist()
    places, items = (at[order] + shallow).tolist(), order.tolist()
    deep = length - shallow
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        trie = BlindTrie()
        for p, item in zip(places[i:j], items[i:j], strict=True):
            trie.insert(text[p:p + deep], item)
        for leaf in trie.ordered():
            if len(leaf) > 1:
                out.extend(leaf)
                out_group.extend([number] * len(leaf))
                number += 1
    return np.array(out, np.int64), np.array(out_group, np.int64)


class Batch:
    def __init__(self, table: pa.Table, length: int, gram: int):
        self.table, self.length = sorted_rows(table), length
        self.texts = texts(self.table["text"])
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.ids = ids(self.table)
        hashes, starts, ends, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        for i, t in enumerate(self.texts):
            found = anchors(t, length, gram)
            if found is not None:
                h, s = found
                hashes.append(h)
                starts.append(s)
                ends.append(np.append(s[1:], len(t) - length + 1))
                docs.append(np.full(len(h), i, np.int64))
        self.h, self.start, self.end = np.concatenate(hashes), np.concatenate(starts), np.concatenate(ends)
        self.doc = np.concatenate(docs) if docs else np.empty(0, np.int64)
        self.keys, first, self.of = np.unique(self.h, return_index=True, return_inverse=True)
        last = np.zeros(len(self.keys), np.int64)
        last[self.of] = self.doc  # documents ascend: the last one wins
        self.several = last != self.doc[first]

    def kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, kinds of segment) where there are more than ``FEW``."""
        often = np.flatnonzero((np.bincount(self.of, minlength=len(self.keys)) > FEW)[self.of])
        seen: dict[int, set[bytes]] = {}
        for k, i, s, e in zip(self.of[often].tolist(), self.doc[often].tolist(), self.start[often].tolist(), self.end[often].tolist(), strict=True):
            seen.setdefault(k, set()).add(self.texts[i][s:e + self.length - 1])
        found = sorted((k, len(v)) for k, v in seen.items() if len(v) > FEW)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def anchors_blob(self, kinds: tuple[np.ndarray, np.ndarray]):
        def blob(i: int, j: int) -> bytes:
            low = (self.keys[i:j] & np.uint64(0x7FFFFFFF)).astype(np.uint32)
            a, b = np.searchsorted(kinds[0], [i, j]).tolist()
            return np.int64(j - i).tobytes() + (low << 1 | self.several[i:j]).astype("<u4").tobytes() \
                + np.column_stack([kinds[0][a:b] - i, kinds[1][a:b]]).astype("<u4").tobytes()

        return blob

    def segments(self, live: np.ndarray, hot: np.ndarray) -> None:
        """Distinct segments of live anchors, in the order of their hashes; those of
        hot anchors cut into single strings."""
        live, hot = live[self.of], hot[self.of]
        held, cut = np.flatnonzero(live & ~hot), np.flatnonzero(live & hot)
        n = self.end[cut] - self.start[cut]
        doc = np.repeat(self.doc[cut], n)
        start = np.repeat(self.start[cut], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own = np.array([xxhash.xxh64_intdigest(self.texts[i][s:s + self.length]) for i, s in zip(doc.tolist(), start.tolist(), strict=True)], np.uint64)
        h = np.concatenate([self.h[held], own])
        by = np.argsort(h, kind="stable")
        h, doc, end = h[by], np.concatenate([self.doc[held], doc])[by], np.concatenate([self.end[held], start + 1])[by]
        start = np.concatenate([self.start[held], start])[by]
        seen: dict[bytes, int] = {}
        which, firsts = np.empty(len(h), np.int64), []
        more = self.length - 1
        for n, (i, s, e) in enumerate(zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)):
            seg = self.texts[i][s:e + more]
            number = seen.get(seg)
            if number is None:
                number = seen[seg] = len(seen)
                firsts.append(n)
            which[n] = number
        self.held_doc, self.held_start, self.which, self.parts = doc, start, which, list(seen)
        self.seg_hash, self.seg_doc = h[firsts], self.ids[doc[firsts]]
        self.seg_starts = end[firsts] - start[firsts]
        self.seg_at = np.concatenate([[0], np.cumsum(self.seg_starts)])

    def segments_blob(self, i: int, j: int) -> bytes:
        return np.int64(j - i).tobytes() + self.seg_doc[i:j].astype("<i8").tobytes() + (self.seg_hash[i:j] & _LOWER).astype("<u4").tobytes() \
            + self.seg_starts[i:j].astype("<u2").tobytes() + b"".join(self.parts[i:j])

    def result(self, first: np.ndarray) -> pa.Table:
        """first: for each start of each distinct segment, whether no smaller id has the string."""
        base = np.cumsum(self.sizes) - self.sizes
        n = self.seg_starts[self.which]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        later = self.ids[self.held_doc] > self.seg_doc[self.which]
        gone = np.repeat(later, n) | ~first[np.repeat(self.seg_at[self.which], n) + step]
        at = (np.repeat(base[self.held_doc] + self.held_start, n) + step)[gone]
        total = int(self.sizes.sum())
        edge = np.bincount(at, minlength=total + 1)[:total + 1] - np.bincount(at + self.length, minlength=total + 1)[:total + 1]
        removed = np.cumsum(edge[:total]) > 0
        n_removed, spans, digests = [], [], []
        for t, b in zip(self.texts, base.tolist(), strict=True):
            mask = removed[b:b + len(t)]
            k = int(mask.sum())
            n_removed.append(k)
            spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if k else 0)
            digests.append(hashlib.sha256(np.frombuffer(t, np.uint8)[~mask].tobytes() if k else t).hexdigest())
        return pa.table({"doc_id": self.table["doc_id"], "n_bytes": self.sizes, "n_removed": pa.array(n_removed, pa.int64()),
                         "n_spans": pa.array(spans, pa.int64()), "kept_sha256": digests})


def _live(hot: int):
    def run(table: pa.Table) -> pa.Table:
        parts, weights = [], []
        for blob in table["blob"].to_pylist():
            n = int(np.frombuffer(blob, "<i8", 1)[0])
            parts.append(np.frombuffer(blob, "<u4", n, 8))
            pairs = np.frombuffer(blob, "<u4", -1, 8 + 4 * n).reshape(-1, 2)
            weight = np.full(n, FEW, np.int64)
            weight[pairs[:, 0]] = pairs[:, 1]
            weights.append(weight)
        every, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        keys, of = np.unique(every >> 1, return_inverse=True)
        seen = np.bincount(of, weights=1 + (every & 1).astype(np.int64), minlength=len(keys)) > 1
        many = seen & (np.bincount(of, weights=np.concatenate(weights), minlength=len(keys)) > hot)
        live = answer(table, 1, seen[of], counts)
        if not many.any():
            return live
        some = np.array([w.any() for w in np.split(many[of], np.cumsum(counts)[:-1])])  # no bit set: nothing to answer
        return pa.concat_tables([live, answer(table, 3, many[of], counts).filter(pa.array(some))])

    return run


def _sort_range(length: int, shallow: int):
    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        parts, which, docs, hashes, counts, lengths = [], [], [], [], [], []
        for blob in table["blob"].to_pylist():
            n = int(np.frombuffer(blob, "<i8", 1)[0])
            docs.append(np.frombuffer(blob, "<i8", n, 8))
            hashes.append(np.frombuffer(blob, "<u4", n, 8 + 8 * n))
            starts = np.frombuffer(blob, "<u2", n, 8 + 12 * n).astype(np.int64)
            ends = (8 + 14 * n + np.cumsum(starts + length - 1)).tolist()
            for i, j in zip([8 + 14 * n, *ends[:-1]], ends, strict=True):
                seg = blob[i:j]
                k = number.get(seg)
                if k is None:
                    k = number[seg] = len(parts)
                    parts.append(seg)
                which.append(k)
            lengths.append(starts)
            counts.append(int(starts.sum()))
        doc, anchor, starts = np.concatenate(docs), np.concatenate(hashes), np.concatenate(lengths)
        which = np.array(which, np.int64)
        least = np.full(len(parts), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)  # equal segments: the smallest id
        one = np.empty(len(parts), np.int64)
        one[which] = np.arange(len(which))
        kind_starts, kind_anchor = starts[one], anchor[one]
        at = np.cumsum(kind_starts) - kind_starts
        best = np.repeat(least, kind_starts)  # smallest id known of each string
        # suffixes of anchors with several kinds of segment
        _, of, kinds = np.unique(kind_anchor, return_inverse=True, return_counts=True)
        todo = np.flatnonzero(kinds[of] > 1)
        if len(todo):
            sizes = np.array([len(parts[k]) for k in todo])
            n = kind_starts[todo]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = np.repeat(np.cumsum(sizes) - sizes, n) + step
            string = np.repeat(at[todo], n) + step
            order, group = equal_suffixes(b"".join([parts[k] for k in todo]), place, length, shallow)
            if len(order):
                found = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
                np.minimum.at(found, group, best[string[order]])
                best[string[order]] = found[group]
        step = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
        bits = best[np.repeat(at[which], starts) + step] == np.repeat(doc, starts)
        return answer(table, 2, bits, np.array(counts))

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW, unit: int = 4 << 20,
                 hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if not 1 <= gram <= length or length > 60_000:
        raise ValueError("1 <= gram <= length <= 60000")
    n, ranges_n = batch_plan(text_bytes(docs), unit)
    batches = with_batch(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), n, ["doc_id", "text"])

    def bounds(b: Batch) -> np.ndarray:
        return ranges(b.seg_hash, ranges_n)

    def cut(b: Batch, answers: pa.Table) -> None:
        asked = ranges(b.keys, ranges_n)
        b.segments(answered(answers, 1, asked), answered(answers, 3, asked))

    def offer(table: pa.Table) -> pa.Table:
        b = Batch(table, length, gram)
        return send(table["pid"][0].as_py(), ranges(b.keys, ranges_n), b.anchors_blob(b.kinds()))

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"p": pa.array([], pa.int32()), "pid": pa.array([], pa.int32()), "blob": pa.array([], pa.binary())})
        b = Batch(table, length, gram)
        cut(b, answers)
        return send(table["pid"][0].as_py(), bounds(b), b.segments_blob)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(table, length, gram)
        cut(b, answers)
        return b.result(answered(answers, 2, b.seg_at[bounds(b)]))

    live = batches.groupBy("pid").applyInArrow(offer, SENT).groupBy("p").applyInArrow(_live(max(hot, FEW * n)), ANSWER)
    firsts = batches.groupBy("pid").cogroup(live.groupBy("pid")).applyInArrow(extend, SENT).groupBy("p").applyInArrow(_sort_range(length, shallow), ANSWER)
    return batches.groupBy("pid").cogroup(live.unionByName(firsts).groupBy("pid")).applyInArrow(remove, RESULT)

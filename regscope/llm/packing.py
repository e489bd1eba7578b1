"""Packing documents into training sequences by vector bin packing.

A sequence holds at most ``max_tokens`` tokens, ``max_segments`` pieces and
``max_loss`` loss-bearing tokens at once. Documents are cut at full sequences;
what is left of each is an item with three demands. One sequence is open at a
time: the item whose demand vector has the largest dot product with the
sequence's free room (each dimension scaled by its limit and weighted by its
mean demand) goes in next, of those that fit. Where none fits and at least
``min_cut`` tokens are free, the best item is cut to fill the room. What remains
in the end, less than one sequence per batch, is written as sequences of
power-of-two lengths, which need no padding.

Documents are dealt to batches by hash; a batch is one task's work. Null text is
empty: its piece is the end id alone. Rows that repeat an id are packed each.
An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regscope.llm.common import batch_plan, text_bytes, with_batch
from regscope.llm.words import CACHES, fresh, mix, texts

# Fixed values of the contract.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MAX_TOKENS = 4096
MAX_SEGMENTS = 512
MIN_CUT = 16
#: Words that are remembered, and bytes of their ids.
CACHE_WORDS = 1_000_000
CACHE_BYTES = 24 << 20
#: Bytes of text that are worked off at a time.
PIECE = 4 << 20
#: Longest word (bytes) that is remembered as a number.
SHORT = 15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BLANK_RUN = re.compile(rb"[\x20\x09-\x0D]")
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Words tokenized at a time as one text.
JOINED = 4_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _letters(word: bytes) -> bool:
    """Whether a word is one run of letters, as it is and as the tokenizer sees it:
    NFC and lower case turn 60 letters into a letter and a mark, which would join
    the full stops and commas behind it."""
    text = word.decode()
    return text.isalpha() and (text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha())


class WordIds:
    """Token ids of words, remembered. The tokenizer never joins characters across
    ASCII blanks and drops them, so a text's ids are its words' ids, one after the
    other; letters and the full stops or commas behind them are taken apart as well, if
    they are letters still as the tokenizer normalizes them, and ASCII case does not count.

    Words of up to 15 bytes are numbers: their bytes and their length fill 128 bits, so
    that a batch's words are found, told apart and looked up as arrays, and equal
    numbers are equal words. Longer ones, few, are a dictionary. A batch's new words are
    tokenized together. When the memory is full, words not met since it last was are
    forgotten."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.long: dict[bytes, bytes] = {}
        # remembered words by hash: 128 bits, where their ids are in ``pool``, how many, met of late
        self.h, self.low, self.high = (np.empty(0, np.uint64) for _ in range(3))
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.met = np.empty(0, bool)
        self.pool = np.empty(0, np.uint32)

    def _ids(self, words: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def _tokenize(self, letters: list[bytes], others: list[bytes]) -> dict[bytes, bytes]:
        """Runs of letters are tokenized many at a time: each ends with an end-of-word id."""
        found: dict[bytes, bytes] = {}
        for i in range(0, len(letters), JOINED):
            part = letters[i:i + JOINED]
            ids = self._ids([b" ".join(part)])[0]
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(part) or ends[-1] != 4 * len(ids):
                others = others + part
                continue
            data, at = ids.tobytes(), 0
            for w, end in zip(part, ends.tolist(), strict=True):
                found[w] = data[at:end]
                at = end
        found.update(zip(others, (i.tobytes() for i in self._ids(others)), strict=True))
        return found

    def _known(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of those words that are remembered."""
        found = {w: self.long[w] for w in words if w in self.long}
        if words and len(self.h):
            blob, start, size = _joined(words)
            h, low, high = _numbers(blob, start, size)
            at = self._find(h, low, high)
            at[size > SHORT] = -1
            hit = np.flatnonzero(at >= 0)
            for i, a, n in zip(hit.tolist(), self.at[at[hit]].tolist(), self.n[at[hit]].tolist(), strict=True):
                found[words[i]] = self.pool[a:a + n].tobytes()
        return found

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of new words."""
        cores = [w.lower().rstrip(b".,") for w in words]
        # bytes.isalpha knows ASCII letters alone, and is quick
        plain = [c.isalpha() or _letters(c) for c in cores]
        letters = list({c for c, p in zip(cores, plain, strict=True) if p})
        known = self._known(letters)
        letters = [c for c in letters if c not in known]
        others = {w[len(c):] if p else w for w, c, p in zip(words, cores, plain, strict=True)} - {b""}
        fresh_ids = self._tokenize(letters, list(others))
        known.update(fresh_ids)
        new = set(words)
        self._remember([c for c in letters if c not in new], fresh_ids)
        known[b""] = b""
        return [known[c] + known[w[len(c):]] if p else known[w] for w, c, p in zip(words, cores, plain, strict=True)]

    def _find(self, h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where words are remembered, or -1."""
        at = np.searchsorted(self.h, h)
        at[at == len(self.h)] = 0
        if not len(self.h):
            return np.full(len(h), -1)
        return np.where((self.h[at] == h) & (self.low[at] == low) & (self.high[at] == high), at, -1)

    def _remember(self, words: list[bytes], ids: dict[bytes, bytes]) -> None:
        """Add words, none of them remembered yet. Of words of one hash the first stays."""
        if not words:
            return
        blob, start, size = _joined(words)
        h, low, high = _numbers(blob, start, size)
        data = [ids[w] for w in words]
        n = np.fromiter(map(len, data), np.int64, len(data)) // 4
        short = size <= SHORT
        for i in np.flatnonzero(~short).tolist():
            self.long[words[i]] = data[i]
        by = np.argsort(h, kind="stable")
        short[by[1:][h[by[1:]] == h[by[:-1]]]] = False
        if len(self.h):
            short &= self.h[np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)] != h
        added = np.frombuffer(b"".join(data), "<u4")
        at = len(self.pool) + np.cumsum(n) - n
        self.pool = np.concatenate([self.pool, added])
        by = np.argsort(np.concatenate([self.h, h[short]]), kind="stable")
        for name, new in (("h", h), ("low", low), ("high", high), ("at", at), ("n", n), ("met", np.ones(len(h), bool))):
            setattr(self, name, np.concatenate([getattr(self, name), new[short]])[by])

    def _keep(self, kept: np.ndarray) -> None:
        at, n = self.at[kept], self.n[kept]
        self.pool = self.pool[_runs(at, n)]
        for name in ("h", "low", "high"):
            setattr(self, name, getattr(self, name)[kept])
        self.at, self.n, self.met = np.cumsum(n) - n, n, np.zeros(len(n), bool)

    def _make_room(self) -> None:
        if len(self.h) > CACHE_WORDS or self.pool.nbytes > CACHE_BYTES:
            self._keep(self.met)
            if len(self.h) > CACHE_WORDS // 2 or self.pool.nbytes > CACHE_BYTES // 2:
                self._keep(self.met)  # nothing is met since: all go
        if sum(map(len, self.long)) > CACHE_BYTES // 4:
            self.long.clear()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (little-endian unsigned 32-bit)."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            for piece in _pieces(t):
                held.append((i, piece))
                size += len(piece)
                if size >= PIECE:
                    self._encode(held, out)
                    held, size = [], 0
        if held:
            self._encode(held, out)
        return [b"".join(o) for o in out]

    def _encode(self, held: list[tuple[int, bytes]], out: list[list[bytes]]) -> None:
        self._make_room()
        blob, begin, length = _joined([t for _, t in held])
        start, size = _words(blob)
        h, low, high = _numbers(blob, start, size)
        short = size <= SHORT
        by = np.argsort(h[short])
        at_short = np.flatnonzero(short)[by]
        sorted_h = h[at_short]
        new = np.ones(len(by), bool)
        new[1:] = sorted_h[1:] != sorted_h[:-1]
        first = at_short[new]
        kind = np.empty(len(h), np.int64)
        kind[at_short] = np.cumsum(new) - 1
        # words of one hash that are not the same word, should there be any, go with the long ones
        same = (low[first[kind[at_short]]] == low[at_short]) & (high[first[kind[at_short]]] == high[at_short])
        short[at_short[~same]] = False
        todo = first[self._find(h[first], low[first], high[first]) < 0]
        data = blob.tobytes()

        def of(at: np.ndarray) -> list[bytes]:
            return [data[s:s + n] for s, n in zip(start[at].tolist(), size[at].tolist(), strict=True)]

        words = of(todo)
        unknown = list(set(of(np.flatnonzero(~short))) - self.long.keys() - set(words))
        learned = dict(zip(words + unknown, self._learn(words + unknown), strict=True))
        self._remember(words, learned)
        self.long.update((w, learned[w]) for w in unknown)
        at = self._find(h[first], low[first], high[first])
        self.met[at[at >= 0]] = True
        short[short] = at[kind[short]] >= 0
        rest = np.flatnonzero(~short)
        # each word's ids: in the pool, or behind it
        odd = [self.long[w] if w in self.long else learned[w] for w in of(rest)]
        n, place = np.empty(len(h), np.int64), np.empty(len(h), np.int64)
        n[short], place[short] = self.n[at][kind[short]], self.at[at][kind[short]]
        n[rest] = np.fromiter(map(len, odd), np.int64, len(odd)) // 4
        place[rest] = len(self.pool) + np.cumsum(n[rest]) - n[rest]
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(odd), "<u4")]) if odd else self.pool
        ids = pool[_runs(place, n)].astype("<u4").tobytes()
        ends = np.append(0, np.cumsum(n) * 4)
        edge = ends[np.searchsorted(start, np.append(begin, begin[-1] + length[-1]))].tolist()
        for (i, _), a, b in zip(held, edge[:-1], edge[1:], strict=True):
            out[i].append(ids[a:b])


def _pieces(text: bytes) -> list[bytes]:
    """A text, or the parts of a very long one, cut at blanks."""
    if len(text) <= PIECE:
        return [text]
    out, at = [], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = _BLANK_RUN.search(text, end)
            end = found.start() if found else len(text)
        out.append(text[at:end])
        at = end
    return out


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts in one array, blanks around each, and where they begin, and their lengths."""
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    blob = np.frombuffer(b" " + b" ".join(parts) + b" " * 17, np.uint8)
    return blob, np.cumsum(size + 1) - size, size


def _words(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and their lengths."""
    inside = ~_BLANK[blob]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2], edges[1::2] - edges[0::2]


def _numbers(blob: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, low, high): a word's first 8 bytes, its next 7 with its length above them,
    and a hash of both. Words above ``SHORT`` bytes get numbers that mean nothing."""
    eight = np.lib.stride_tricks.sliding_window_view(blob, 8)
    low = np.ascontiguousarray(eight[start]).view("<u8").ravel() & _MASK[np.minimum(size, 8)]
    high = np.zeros(len(start), np.uint64)
    more = np.flatnonzero(size > 8)
    high[more] = np.ascontiguousarray(eight[start[more] + 8]).view("<u8").ravel() & _MASK[np.minimum(size[more] - 8, 7)]
    high |= np.minimum(size, SHORT + 1).astype(np.uint64) << np.uint64(56)
    with np.errstate(over="ignore"):
        return mix(low ^ mix(high)), low, high


def _runs(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Every index of runs that begin at ``at`` and have ``n`` members."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


_IDS: dict[str, WordIds] = {}
CACHES.append(_IDS)


def tokenizer_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return path


def word_ids(path: str | None) -> WordIds:
    path = tokenizer_path(path)
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def pack(tokens: np.ndarray, loss: np.ndarray, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss: int = MAX_TOKENS, min_cut: int = MIN_CUT) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length). ``loss``: loss-bearing tokens
    of each item, taken as its last ones (an instruction's answer)."""
    sequences: list[list[tuple[int, int, int]]] = []
    start = np.zeros(len(tokens), np.int64)

    def loss_of(i: int, s: int, n: int) -> int:
        first = int(tokens[i]) - int(loss[i])
        return max(0, s + n - max(s, first))

    for i in range(len(tokens)):  # whole sequences of one document
        while tokens[i] - start[i] >= max_tokens or loss_of(i, start[i], tokens[i] - start[i]) > max_loss:
            n = min(max_tokens, int(tokens[i] - start[i]))
            over = loss_of(i, start[i], n) - max_loss
            n -= max(0, over)
            sequences.append([(i, int(start[i]), n)])
            start[i] += n
    left = tokens - start
    # items of equal demands are one class: a placement looks at classes, not at items
    demand = np.stack([left, np.minimum(loss, left)], axis=1)
    alive = np.flatnonzero(left > 0)
    if not len(alive):
        return sequences
    kinds, of = np.unique(demand[alive], axis=0, return_inverse=True)
    stacks: list[list[int]] = [[] for _ in kinds]
    for item, kind in zip(alive[::-1].tolist(), of.ravel()[::-1].tolist(), strict=True):
        stacks[kind].append(item)
    limit = np.array([max_tokens, max_segments, max_loss], float)
    need = np.column_stack([kinds[:, 0], np.ones(len(kinds)), kinds[:, 1]]).astype(float)
    count = np.array([len(s) for s in stacks])
    mean = (need * count[:, None]).sum(axis=0) / count.sum() / limit
    score = need / limit * (mean / limit)  # times the free room gives the weighted dot product
    need, score = [c.copy() for c in need.T], [c.copy() for c in score.T]
    room, current = limit.copy(), []
    waiting = int(count.sum())
    while waiting:
        dot = score[0] * room[0] + score[1] * room[1] + score[2] * room[2]
        dot[(count == 0) | (need[0] > room[0]) | (need[1] > room[1]) | (need[2] > room[2])] = -1.0
        k = int(dot.argmax())
        if dot[k] >= 0:
            i = stacks[k].pop()
            waiting -= 1
            count[k] -= 1
            current.append((i, int(start[i]), int(tokens[i] - start[i])))
            room -= [c[k] for c in need]
            continue
        if room[0] >= min_cut and room[1] >= 1:
            dot = score[0] * room[0] + score[1] * room[1] + score[2] * room[2]
            k = int(np.where(count > 0, dot, -1.0).argmax())
            i = stacks[k][-1]
            n = int(min(room[0], tokens[i] - start[i]))
            n -= max(0, loss_of(i, int(start[i]), n) - int(room[2]))
            if n >= min_cut and n < tokens[i] - start[i]:
                stacks[k].pop()
                count[k] -= 1
                current.append((i, int(start[i]), n))
                start[i] += n
                rest = np.array([tokens[i] - start[i], 1, min(loss[i], tokens[i] - start[i])], float)
                same = np.flatnonzero((need[0] == rest[0]) & (need[2] == rest[2]))
                if len(same):
                    j = int(same[0])
                    stacks[j].append(i)
                    count[j] += 1
                else:
                    stacks.append([i])
                    need, count = [np.append(c, x) for c, x in zip(need, rest, strict=True)], np.append(count, 1)
                    score = [np.append(c, x) for c, x in zip(score, rest / limit * (mean / limit), strict=True)]
        sequences.append(current)
        room, current = limit.copy(), []
    if current:
        sequences += _tail(current, max_tokens, min_cut)
    return sequences


def _tail(pieces: list[tuple[int, int, int]], max_tokens: int, min_cut: int) -> list[list[tuple[int, int, int]]]:
    """The last sequence: as it is if nearly full, else cut in powers of two."""
    total = sum(n for _, _, n in pieces)
    if total > max_tokens - min_cut:
        return [pieces]
    lengths = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
    out, todo = [], list(reversed(pieces))
    for size in lengths:
        seq, free = [], size
        while free:
            i, s, n = todo.pop()
            take = min(n, free)
            seq.append((i, s, take))
            free -= take
            if take < n:
                todo.append((i, s + take, n - take))
        out.append(seq)
    return out


def pack_documents(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                   max_loss: int = MAX_TOKENS, min_cut: int = MIN_CUT, unit: int = 4 << 20,
                   loss_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. ``loss_col``: how many of a document's last tokens, its
    end id among them, bear loss; without it, or where it is null, all do."""
    n, _ = batch_plan(text_bytes(docs), unit)
    columns = ["doc_id", "text"]
    if loss_col is not None:
        columns.append(docs[loss_col].cast("long").alias("loss"))
    return with_batch(docs, n, columns).groupBy("pid").applyInArrow(
        packer(path, max_tokens, max_segments, max_loss, min_cut), SCHEMA)


def packer(path: str | None, max_tokens: int, max_segments: int, max_loss: int, min_cut: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        fresh()
        own = "loss" in table.column_names
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "text", *["loss"] * own)])
        ids, end = word_ids(path), np.array([END_ID], "<u4").tobytes()
        held = [i + end for i in ids.encode(texts(table["text"]))]
        tokens = np.array([len(h) // 4 for h in held], np.int64)
        loss = tokens
        if own:
            given = table["loss"].combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            loss = np.clip(given, 0, tokens)
        rows: list[tuple[int, int, int, int, int, int]] = []
        for seq, pieces in enumerate(pack(tokens, loss, max_tokens, max_segments, max_loss, min_cut)):
            at = 0
            for i, s, k in pieces:
                rows.append((i, s, k, zlib.crc32(memoryview(held[i])[4 * s:4 * (s + k)]), seq, at))
                at += k
        a = np.array(rows, dtype=np.int64).reshape(-1, 6)
        item = a[:, 0]
        pid = table["pid"][0].as_py()
        return pa.table({"doc_id": table["doc_id"].combine_chunks().cast(pa.int64()).take(pa.array(item)), "start": a[:, 1], "length": a[:, 2],
                         "ids_crc32": a[:, 3], "doc_tokens": tokens[item], "sequence_id": (np.int64(pid) << np.int64(32)) + a[:, 4], "offset": a[:, 5]})

    return run

"""Words and their hashes inside a task, on numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

#: Distinct words kept by a task's cache before it starts anew, and the longest (bytes)
#: that is kept at all: together they bound a cache in bytes.
CACHE_WORDS = 300_000
CACHE_LENGTH = 64
BASE = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word (bytes) to 64-bit hash, computed once per distinct word."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


_HASHES = WordHashes()
#: What Python workers hold beyond a task, all of it, and the Spark stage it is of.
CACHES: list[dict] = [_HASHES]
_STAGE: list[int | None] = [None]


def fresh() -> None:
    """Every task begins with this. A Python worker outlives its stage: what tasks of
    an earlier stage cached is dropped, so that stages do not add up."""
    context = TaskContext.get()
    now = context.stageId() if context else None
    if now != _STAGE[0]:
        _STAGE[0] = now
        for cache in CACHES:
            cache.clear()


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: Iterable[int], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows, [from, to), of about ``limit`` bytes each."""
    start, held, i = 0, 0, 0
    for i, n in enumerate(sizes, 1):
        held += n
        if held >= limit:
            yield start, i
            start, held = i, 0
    if start < i:
        yield start, i


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(z: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit hash (all output bits depend on all input bits)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def rolling(h: np.ndarray, length: int, base: np.uint64 = BASE) -> np.ndarray:
    """Polynomial hash of every window of ``length`` consecutive values, by
    doubling; fewer values than that give none."""
    n = len(h) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, have, part, width, power = None, 0, h, 1, base
    todo = length
    with np.errstate(over="ignore"):
        while True:
            if todo & 1:  # append a block of ``width`` to what is held
                if out is None:
                    out, have = part, width
                else:
                    m = min(len(out), len(part) - have)
                    out = out[:m] * power + part[have:have + m]
                    have += width
            todo >>= 1
            if not todo:
                return mix(out[:n].copy())
            part = part[:-width] * power + part[width:]
            width, power = width * 2, power * power

"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that the array steps take at once (they need about 60 times that).
BLOCK_BYTES = 1 << 20
#: Space and the five control characters from tab to carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def blocks(sizes: Iterable[int], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts, each of about ``limit`` bytes or of one text."""
    start = at = total = 0
    for size in sizes:
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
        at += 1
    if at > start:
        yield start, at


def give_back() -> None:
    """Returns what freed arrays took to the system: workers outlive their tasks and share
    an executor's memory with the workers of the next ones."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


@cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim  # glibc only
    except (AttributeError, OSError, TypeError):
        return None


class Words:
    """Where the words of some texts lie.

    raw: the texts with a line break after each, as bytes; starts, ends: of each word in
    raw; per_text: how many words each text has.
    """

    _hashes: np.ndarray | None = None

    def __init__(self, texts: list[bytes], between: np.ndarray = WHITE):
        self.raw = b"\n".join([*texts, b""])
        self.bytes = np.frombuffer(self.raw, np.uint8)
        inside = ~between[self.bytes]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        if len(edges) % 2:
            edges = np.append(edges, len(inside))
        self.starts, self.ends = edges[::2], edges[1::2]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(self.starts, text_ends)
        self.per_text = np.diff(upto, prepend=0)

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i]:self.ends[i]]

    def hashes(self) -> np.ndarray:
        """64 bits of each word: sums of random numbers of its bytes by powers, then mixed. Made once."""
        if self._hashes is None:
            self._hashes = self._hashed()
            self._hashes.flags.writeable = False
        return self._hashes

    def _hashed(self) -> np.ndarray:
        if not len(self):
            return np.empty(0, np.uint64)
        table, powers = _numbers()
        longest = int((self.ends - self.starts).max())
        if longest > len(powers):
            powers = np.concatenate([powers, _powers(longest)[len(powers):]])
        # place of each byte in its word; what it is between words doesn't matter
        started = np.zeros(len(self.bytes), np.int64)
        started[self.starts] = self.starts
        place = np.arange(len(self.bytes)) - np.maximum.accumulate(started)
        np.minimum(place, len(powers) - 1, out=place)
        parts = table[self.bytes] * powers[place]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(parts, dtype=np.uint64)])
        return mixed(sums[self.ends] - sums[self.starts] + (self.ends - self.starts).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers spread over all 64 (two multiply and shift rounds)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, np.uint64(0x9E3779B97F4A7C15))
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


@cache
def _numbers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), _powers(4096)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """64 bits of each run of ``n`` word hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size = len(h) - n + 1
    out = np.zeros(size, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:size + j]
    return mixed(out)

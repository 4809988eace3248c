"""Hashes of all words of many texts at once, with numpy, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
STEP = 1 << 18
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of words as polynomials over bytes, from prefix sums; A-Z count as a-z if asked for."""

    def __init__(self, lower: bool = True):
        values = np.arange(1, 257, dtype=np.uint64)
        if lower:
            values[65:91] = values[97:123]
        self.values = mix(values * np.uint64(BASE))
        self.space = np.zeros(256, dtype=bool)
        self.space[list(SPACE_BYTES)] = True
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverse = self.powers

    def _reach(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, STEP + 4096)
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _piece(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self._reach(len(data))
        blank = np.concatenate(([True], self.space[data], [True]))
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return starts, mix((sums[ends] - sums[starts]) * self.inverse[starts])

    def _pieces(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cuts at white space, so that a very long text is hashed in pieces of bounded memory."""
        at = 0
        while at < len(data):
            end = min(at + STEP, len(data))
            while end < len(data):
                gap = np.flatnonzero(self.space[data[max(at, end - 4096) : end]])
                if len(gap):
                    end = max(at, end - 4096) + int(gap[-1]) + 1
                    break
                end = min(end + STEP, len(data))
            yield at, end
            at = end

    def words(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All word hashes in order, and for each text where its words start (one more entry at the end)."""
        raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        offsets = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        starts, hashes = [], []
        for at, end in self._pieces(data):
            s, h = self._piece(data[at:end])
            starts.append(s + at)
            hashes.append(h)
        if not starts:
            return np.zeros(0, dtype=np.uint64), np.zeros(len(raw) + 1, dtype=np.int64)
        return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbouring words; runs that cross texts are the caller's to skip."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = 1
    for i in range(k):
        factor = factor * BASE % (1 << 64)
        total += hashes[i : i + n] * np.uint64(factor)
    return mix(total)


def chunks(texts: Sequence[str], limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters; a longer text stands alone."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        size = len(t) if t else 0
        if i > at and held + size > limit:
            yield at, i
            at, held = i, 0
        held += size
    if at < len(texts):
        yield at, len(texts)

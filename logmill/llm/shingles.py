"""Word shingles of texts as sorted sets of 64-bit hashes, in numpy."""

from __future__ import annotations

import re

import numpy as np

from logmill.llm.common import mix

WORDS = 5
_WINDOW = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FACTORS = mix(np.arange(1, 16, dtype=np.uint64)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & (2**64 - 1), np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Words:
    """Hashes of a byte string's words, capitals A-Z taken as small letters.

    A word's hash depends on its bytes alone: it is a polynomial in an odd base, read off
    running sums that are rid of the word's place by the base's inverse.
    """

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1), _powers(_BASE, 1)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)

    def hashes(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Each word's hash and the place of its first byte."""
        found, at = [], 0
        while at < len(text):
            end = min(at + _WINDOW, len(text))
            if end < len(text):
                cut = _SPACE.search(text, end)
                end = cut.end() if cut else len(text)
            h, s = self._window(text[at:end].lower())
            found.append((h, s + at))
            at = end
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate([h for h, _ in found]), np.concatenate([s for _, s in found])

    def _window(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(text, np.uint8)
        self._grow(len(x) + 1)
        inside = np.concatenate([[False], ~_IS_SPACE[x], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        sums = np.zeros(len(x) + 1, np.uint64)
        np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.up[: len(x)], out=sums[1:])
        value = (sums[end] - sums[start]) * self.down[start]
        return mix(value ^ ((end - start).astype(np.uint64) << np.uint64(56))), start


def sets_of(texts: list[bytes], words: Words, width: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words; with fewer
    words, of the whole sequence; without words, none."""
    sets: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) <= _WINDOW):
            size += len(texts[upto]) + 1
            upto += 1
        part = texts[at:upto]
        h, starts = words.hashes(b"\n".join(part))
        offsets = np.cumsum([0, *(len(t) + 1 for t in part)])
        bounds = np.searchsorted(starts, offsets)
        runs = _runs(h, width) if len(h) >= width else h[:0]
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                sets.append(np.unique(runs[a : b - width + 1]))
            elif b > a:
                sets.append(_runs(h[a:b], b - a) ^ np.uint64(b - a))
            else:
                sets.append(h[:0])
        at = upto
    return sets


def _runs(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += h[k : k + n] * _FACTORS[k]
    return mix(total)

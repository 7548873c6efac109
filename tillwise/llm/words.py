"""Words of many texts at once: where they are and 64-bit hashes of them, in numpy."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True

#: Start values and odd multipliers of two independent hash functions.
HASHES = ((0xCBF29CE484222325, 0x9E3779B97F4A7C15), (0x84222325CBF29CE4, 0xD6E8FEB86659FD93))


class Words:
    """``first``/``last`` byte of each word in ``data`` and ``doc``, the index of its text."""

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join([b"", *texts, b""])
        self.data = np.frombuffer(joined, dtype=np.uint8)
        inside = ~_SPACE[self.data]
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.first, self.last = turns[::2], turns[1::2]
        begins = 1 + np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.empty(0, int)
        self.doc = np.searchsorted(begins, self.first, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))
        # Position of the first word of each text, and of each word inside its text.
        self.head = np.cumsum(self.counts) - self.counts
        self.place = np.arange(len(self.first)) - self.head[self.doc]

    def hashes(self, which: int) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        start, factor = (np.uint64(x) for x in HASHES[which])
        out = np.full(len(self.first), start, dtype=np.uint64)
        live, step = np.arange(len(self.first)), 0
        sizes = self.last - self.first
        while len(live):
            out[live] = (out[live] ^ self.data[self.first[live] + step]) * factor
            step += 1
            live = live[sizes[live] > step]
        return mixed(out)

    def windows(self, hashes: np.ndarray, width: int, which: int) -> np.ndarray:
        """A hash of each run of ``width`` words, for every word at which a run begins; runs that
        leave their text are there as well, see ``whole``."""
        factor = np.uint64(HASHES[which][1])
        n = max(0, len(hashes) - width + 1)
        out = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            out = out * factor + hashes[k : k + n]
        return mixed(out)

    def whole(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words from each word stays in its text."""
        return self.place + width <= self.counts[self.doc]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the high bits down (all 64 bits of a hash matter for sorting and dealing)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))

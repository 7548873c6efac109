"""Word n-grams of many texts interned at once: an open-addressed table in numpy.

An n-gram is a span of a byte array in which words are joined by one space. Its key is its XXH64; a
slot of the table has the key and one n-gram that owns it, and every other one that claims the slot is
compared with the owner byte by byte, so colliding keys never merge.
"""

from __future__ import annotations

import zlib

import numpy as np

P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
#: Longer spans are hashed by the library, one call each.
LONG_SPAN = 256
#: Zero bytes kept behind the data, so that eight bytes can be read at every place.
PAD = 8


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Spans:
    """Spans of ``data`` (its last ``PAD`` bytes are zero), by ``first`` byte and ``size``."""

    def __init__(self, data: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.data, self.first, self.size = data, first, size
        # Eight bytes from every place, as views into the data.
        self.eight = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
        self.four = np.ndarray((max(len(data) - 3, 0),), "<u4", data, 0, (1,))

    def keys(self, seed: int = 0) -> np.ndarray:
        """XXH64 of every span."""
        from xxhash import xxh64_intdigest

        out = np.empty(len(self.first), np.uint64)
        order = np.argsort(-self.size, kind="stable")
        sizes = self.size[order]
        long = int(np.searchsorted(-sizes, -LONG_SPAN, side="left"))
        for i in order[:long].tolist():
            a = int(self.first[i])
            out[i] = xxh64_intdigest(self.data[a : a + int(self.size[i])].tobytes(), seed)
        order, sizes = order[long:], sizes[long:]
        at = self.first[order].copy()
        h = np.empty(len(order), np.uint64)
        p1, p2, p5 = int(P1), int(P2), int(P5)
        starts = [np.uint64(s % (1 << 64)) for s in (seed + p1 + p2, seed + p2, seed, seed - p1)]

        def at_least(n: int) -> int:
            """Spans are sorted by size, so those with ``n`` bytes or more are a prefix."""
            return int(np.searchsorted(-sizes, -n, side="right"))

        wide = at_least(32)
        h[wide:] = np.uint64((seed + p5) % (1 << 64))
        if wide:
            v = [np.full(wide, s, np.uint64) for s in starts]
            for stripe in range(1, LONG_SPAN // 32 + 1):
                n = at_least(32 * stripe)
                for lane in range(4):
                    word = self.eight[at[:n] + 8 * lane]
                    v[lane][:n] = _rotated(v[lane][:n] + word * P2, 31) * P1
                at[:n] += 32
            joined = sum((_rotated(x, by) for x, by in zip(v, (1, 7, 12, 18))), np.uint64(0))
            for x in v:
                joined = (joined ^ (_rotated(x * P2, 31) * P1)) * P1 + P4
            h[:wide] = joined
        h += sizes.astype(np.uint64)
        left = sizes % 32
        for step in range(3):
            live = np.flatnonzero(left >= 8 * (step + 1))
            word = _rotated(self.eight[at[live]] * P2, 31) * P1
            h[live] = _rotated(h[live] ^ word, 27) * P1 + P4
            at[live] += 8
        live = np.flatnonzero(left % 8 >= 4)
        h[live] = _rotated(h[live] ^ (self.four[at[live]].astype(np.uint64) * P1), 23) * P2 + P3
        at[live] += 4
        for step in range(3):
            live = np.flatnonzero(left % 4 > step)
            h[live] = _rotated(h[live] ^ (self.data[at[live]].astype(np.uint64) * P5), 11) * P1
            at[live] += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[order] = h ^ (h >> np.uint64(32))
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` (indexes) have the same bytes."""
        out = self.size[a] == self.size[b]
        live = np.flatnonzero(out)
        x, y, size = self.first[a[live]], self.first[b[live]], self.size[a[live]]
        at = 0
        while len(live):
            differ = self.eight[x + at] ^ self.eight[y + at]
            short = np.flatnonzero(size < at + 8)
            # Bytes behind the end of a span do not count.
            differ[short] &= (np.uint64(1) << (8 * (size[short] - at)).astype(np.uint64)) - np.uint64(1)
            out[live[differ != 0]] = False
            at += 8
            go = np.flatnonzero((differ == 0) & (size > at))
            live, x, y, size = live[go], x[go], y[go], size[go]
        return out

    def crc32(self, which: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of the chosen spans."""
        view = memoryview(self.data)
        first, last = self.first[which], self.first[which] + self.size[which]
        found = (zlib.crc32(view[a:b]) for a, b in zip(first.tolist(), last.tolist()))
        return np.fromiter(found, np.int64, len(which))


class Interned:
    """The table of one batch: ``slot`` of every span, and per slot its ``owner`` and ``count``."""

    def __init__(self, spans: Spans):
        n = len(spans.first)
        keys = spans.keys()
        mask = (1 << max(4, int(2 * n).bit_length())) - 1
        owner = np.full(mask + 1, -1, np.int64)
        slot = (keys & np.uint64(mask)).astype(np.int64)
        asking = np.arange(n)
        while len(asking):
            place = slot[asking]
            free = owner[place] < 0
            owner[place[free]] = asking[free]  # of several that ask for a free slot one gets it
            has = owner[place]
            mine = keys[has] == keys[asking]
            check = np.flatnonzero(mine & (has != asking))
            mine[check] = spans.equal(has[check], asking[check])
            asking = asking[~mine]
            slot[asking] = (slot[asking] + 1) & mask
        taken = np.flatnonzero(owner >= 0)
        number = np.empty(mask + 1, np.int64)
        number[taken] = np.arange(len(taken))
        self.slot = number[slot]
        self.owner = owner[taken]
        self.count = np.bincount(self.slot, minlength=len(taken))

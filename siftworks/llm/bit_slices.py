"""Bit-sliced comparison of 64-bit fingerprints.

The fingerprints of a bucket are stored as vertical bit planes, 64 rows a word. All distances of a row to a word's 64
rows are updated together by carry-save counters; words in which every lane is beyond the radius are abandoned as the
planes go by. A bucket gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import numpy as np

BITS = 64


def bit_planes(fps: np.ndarray, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64 x words planes: bit j of a word of plane b is bit b of the word's j-th row. starts, words: each bucket's first row and its number of words."""
    sizes = np.diff(np.append(starts, len(fps)))
    first = np.cumsum(words) - words
    lane = np.arange(len(fps)) - np.repeat(starts, sizes)
    word = np.repeat(first, sizes) + lane // 64
    out = np.zeros((BITS, int(words.sum())), np.uint64)
    at = np.uint64(1) << (lane % 64).astype(np.uint64)
    for b in range(BITS):
        np.bitwise_or.at(out[b], word, np.where(fps >> np.uint64(b) & np.uint64(1), at, np.uint64(0)))
    return out


def near_lanes(planes: np.ndarray, queries: np.ndarray, word: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each (query, word): the word's lanes within the radius, as a bit mask; only items with such lanes are returned.

    Carry-save counters: bit i of a lane's distance stands in counter i; once it passes the radius it stays `over`.
    """
    assert radius in (1, 3, 7, 15), "a power of two less one: one carry out of the counters means beyond it"
    width, item = radius.bit_length(), np.arange(len(queries))
    counters = [np.zeros(len(item), np.uint64) for _ in range(width)]
    over = np.zeros(len(item), np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for b in range(BITS):
        carry = planes[b][word] ^ (np.uint64(0) - (queries >> np.uint64(b) & np.uint64(1)))
        for c in counters:
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if b % 8 == 7 and len(item):  # abandon the words all of whose lanes are beyond the radius
            on = over != full
            if on.sum() < 0.75 * len(on):
                item, word, queries, over = item[on], word[on], queries[on], over[on]
                counters = [c[on] for c in counters]
    on = over != full
    return item[on], ~over[on]


class Buckets:
    """Fingerprints sorted by bucket, as bit planes; buckets of one row are left out."""

    def __init__(self, fps: np.ndarray, bucket: np.ndarray, radius: int, lanes_at_once: int = 1 << 18):
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(fps) else np.empty(0, np.int64)
        sizes = np.diff(np.append(starts, len(fps)))
        #: Places of the rows kept among all.
        self.rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
        self.radius, self.at_once, self.own = radius, lanes_at_once, fps[self.rows]
        sizes = sizes[sizes > 1]
        starts, words = np.cumsum(sizes) - sizes, -(-sizes // 64)
        if len(self.own):
            self.planes, first = bit_planes(self.own, starts, words), np.cumsum(words) - words
            self.per_row, self.row_first, self.row_start, self.row_end = (np.repeat(x, sizes) for x in (words, first, starts, starts + sizes))

    def near(self):
        """Arrays (a, b) of all rows of a bucket within the radius of each other, themselves included, some rows a at a time."""
        ends, at = np.cumsum(self.per_row) if len(self.own) else np.empty(0, np.int64), 0
        while at < len(self.own):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.at_once // 64, "right")))
            q = np.repeat(np.arange(at, to), self.per_row[at:to])
            w = np.arange(len(q)) - np.repeat(np.cumsum(self.per_row[at:to]) - self.per_row[at:to], self.per_row[at:to])
            item, mask = near_lanes(self.planes, self.own[q], self.row_first[q] + w, self.radius)
            if len(item):
                k, lane = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
                a, b = q[item[k]], self.row_start[q[item[k]]] + w[item[k]] * 64 + lane
                keep = b < self.row_end[a]
                yield a[keep], b[keep]
            at = to


def forest(fps: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, root) of a spanning forest of the links inside each bucket; rows are sorted by bucket."""
    buckets = Buckets(fps, bucket, radius)
    label = np.arange(len(buckets.own))
    for a, b in buckets.near():
        _hook(label, a, b)
    away = label != np.arange(len(label))
    return buckets.rows[away], buckets.rows[label[away]]


def partners(fps: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, partner): for each row, of the rows within the radius the one that has most rows within its own, unless that is the row itself.

    Both are within the radius of each other, and what many texts were made from is the partner of them all.
    """
    buckets = Buckets(fps, bucket, radius)
    n = len(buckets.own)
    degree = np.zeros(n, np.int64)
    for a, _ in buckets.near():
        degree += np.bincount(a, minlength=n)
    best = degree * n + (n - 1 - np.arange(n))  # the greater degree, of equals the earlier row
    chosen = best.copy()
    for a, b in buckets.near():
        np.maximum.at(chosen, a, best[b])
    partner = n - 1 - chosen % max(n, 1)
    away = partner != np.arange(n)
    return buckets.rows[away], buckets.rows[partner[away]]


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        x, y = label[a], label[b]
        off = x != y
        if not off.any():
            return
        a, b, x, y = a[off], b[off], x[off], y[off]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]

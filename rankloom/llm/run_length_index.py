"""A run-length index: Burrows-Wheeler transform in runs, with text positions sampled at the ends of runs.

It holds a collection of byte strings and answers matching statistics: for each place of a pattern, the longest prefix
of the pattern's rest that occurs in the collection, and where. Strings and patterns may carry a tag, and then match
within their tag only. The suffix array is needed to make the runs; what is kept of it are the samples at their ends. Patterns are streamed from right to left, many at a
time: a step either follows the transform within a run (LF), or jumps to the nearest run end of the wanted byte above
or below, whichever shares more with what has been matched; positions come from the samples.
"""

from __future__ import annotations

import numpy as np

from .bytes_ops import RangeHash


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling, starting from several symbols packed into one key. All suffixes must differ before the end."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    bits = int(rank.max()).bit_length()
    width = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for j in range(width):
        key <<= bits
        if j < n:
            key[: n - j] |= rank[j:]
    order = np.argsort(key)
    # A suffix's rank is the first slot of the suffixes that it is not yet told from; only these are sorted on.
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    slots = np.arange(n)
    while True:
        first = np.maximum.accumulate(np.where(new, slots, 0))
        if len(slots) == n:
            rank = np.empty(n, np.int64)
        rank[order[slots]] = first
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        key = rank[at] << np.int64(31)
        inside = at + width < n
        key[inside] |= rank[at[inside] + width] + 1
        by = np.argsort(key)
        order[slots] = at[by]
        key = key[by]
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        width *= 2


def _tagged(data: np.ndarray, offsets: np.ndarray, tags: np.ndarray | None) -> np.ndarray:
    """Bytes as symbols; those of other tags are other symbols."""
    out = data.astype(np.int64)
    return out if tags is None else out + np.repeat(tags.astype(np.int64) * 256, np.diff(offsets))


class RunLengthIndex:
    def __init__(self, data: np.ndarray, offsets: np.ndarray, tags: np.ndarray | None = None):
        """data: the strings one after another; offsets: where each begins, and the end; tags: a small number for each."""
        m = len(offsets) - 1
        self.m = m
        sizes = np.diff(offsets)
        # Every string is closed by a symbol of its own, below all bytes.
        at = offsets[:-1] + np.arange(m)
        self.starts = at
        text = np.empty(len(data) + m, np.int64)
        stops = at + sizes
        keep = np.ones(len(text), bool)
        keep[stops] = False
        text[keep] = _tagged(data, offsets, tags) + m
        text[stops] = np.arange(m)
        self.text, self.stops = text, stops
        bytes_with_stops = np.zeros(len(text), np.uint8)
        bytes_with_stops[keep] = data
        self.hash = RangeHash(bytes_with_stops)
        # To the stop at or after each place: a match never runs over one.
        self.room = np.repeat(stops, sizes + 1) - np.arange(len(text))
        sa = suffix_array(text)
        bwt = text[sa - 1]
        new = np.ones(len(bwt), bool)
        new[1:] = bwt[1:] != bwt[:-1]
        self.run_start = np.flatnonzero(new)
        self.run_symbol = bwt[self.run_start]
        run_length = np.diff(np.r_[self.run_start, len(bwt)])
        self.head_position = sa[self.run_start]
        self.tail_position = sa[self.run_start + run_length - 1]
        self.run_tail = self.run_start + run_length - 1
        # LF of a run's first row: symbols below, and the same symbol in runs before.
        order = np.argsort(self.run_symbol, kind="stable")
        before = np.cumsum(run_length[order]) - run_length[order]
        self.lf = np.empty(len(order), np.int64)
        self.lf[order] = before
        self.by_symbol, self.symbol_key = order, self.run_symbol[order] * (len(order) + 1) + order
        self.n_runs, self.n_rows = len(order), len(bwt)

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b, at most `most`, by bisection over hashes."""
        hi = np.minimum(np.minimum(self.room[a], self.room[b]), most)
        lo = np.zeros_like(hi)
        while True:
            open_ = lo < hi
            if not open_.any():
                return lo
            mid = (lo + hi + 1) // 2
            same = self.hash(a, a + mid) == self.hash(b, b + mid)
            lo = np.where(open_ & same, mid, lo)
            hi = np.where(open_ & ~same, mid - 1, hi)

    def step(self, row: np.ndarray, position: np.ndarray, length: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Extends matches (row, its text position, length) by one byte to the left; length 0 where it does not occur."""
        run = np.searchsorted(self.run_start, row, "right") - 1
        wanted = symbol.astype(np.int64) + self.m
        miss = np.flatnonzero(self.run_symbol[run] != wanted)
        if len(miss):
            r, w = run[miss], wanted[miss]
            key = w * (self.n_runs + 1) + r
            q = np.searchsorted(self.symbol_key, key)
            up, down = np.maximum(q - 1, 0), np.minimum(q, self.n_runs - 1)
            up, down = self.by_symbol[up], self.by_symbol[down]
            has_up, has_down = (q > 0) & (self.run_symbol[up] == w), (q < self.n_runs) & (self.run_symbol[down] == w)
            here, most = position[miss], length[miss]
            up_len = np.where(has_up, self._agree(here, self.tail_position[up], most), -1)
            down_len = np.where(has_down, self._agree(here, self.head_position[down], most), -1)
            use_up = up_len >= down_len
            best = np.maximum(up_len, down_len)
            to = np.where(use_up, up, down)
            row, position, length, run = row.copy(), position.copy(), length.copy(), run.copy()
            row[miss] = np.where(use_up, self.run_tail[up], self.run_start[down])
            position[miss] = np.where(use_up, self.tail_position[up], self.head_position[down])
            length[miss] = best
            run[miss] = to
        found = self.run_symbol[run] == wanted
        return (
            np.where(found, self.lf[run] + row - self.run_start[run], row),
            np.where(found, position - 1, position),
            np.where(found, length + 1, 0),
        )

    def matching_statistics(self, data: np.ndarray, offsets: np.ndarray, tags: np.ndarray | None = None, least: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each byte of the patterns: the length of its longest match, a place of it in the text, and its row. Where
        only matches of `least` bytes or more are asked for, a pattern is left as soon as none can follow: a match grows
        by one byte a step at most, so length and bytes left must add up to that. Its other lengths are then 0."""
        data = _tagged(data, offsets, tags)
        length, place, rows = (np.zeros(len(data), np.int64) for _ in range(3))
        left = np.diff(offsets)
        live = np.flatnonzero(left > 0)
        at, left = offsets[1:][live] - 1, left[live]
        row, pos, size = np.zeros(len(live), np.int64), np.full(len(live), self._first(), np.int64), np.zeros(len(live), np.int64)
        while len(at):
            row, pos, size = self.step(row, pos, size, data[at])
            length[at], place[at], rows[at] = size, pos, row
            at, left = at - 1, left - 1
            go_on = left > 0
            if least:
                go_on &= size + left >= least
            if not go_on.all():
                at, left, row, pos, size = (x[go_on] for x in (at, left, row, pos, size))
        return length, place, rows

    def _first(self) -> int:
        return int(self.head_position[0]) if self.n_runs else 0

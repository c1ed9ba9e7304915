"""Vectorised work on the UTF-8 bytes of many texts at once, for Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken together up to so many bytes, so that their hashes stay in a processor's cache; a longer one alone.
SLICE_BYTES = 1 << 17

_U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits depend on all input bits (the finaliser of splitmix64)."""
    out = x >> _U(30)
    out ^= x
    out *= _U(0xBF58476D1CE4E5B9)
    shifted = out >> _U(27)
    out ^= shifted
    out *= _U(0x94D049BB133111EB)
    shifted = out >> _U(31)
    out ^= shifted
    return out


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_MULT))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i below n; kept for the usual size."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(_MULT, -1, 1 << 64)
        made = []
        for p in (_MULT, inverse):
            t = np.full(size, p, np.uint64)
            t[0] = 1
            made.append(np.multiply.accumulate(t))
        if size > 8 << 20:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


class RangeHash:
    """Hashes of any byte ranges of one buffer, from prefix sums: equal strings have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        p, self.inverse = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * p[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Hashes of all ranges of one size, as the call gives them, without picking places."""
        sums = self.sums[size:] - self.sums[: len(self.sums) - size]
        sums *= self.inverse[: len(sums)]
        sums += _U(size)
        return mix(sums)


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for consecutive rows of a string or binary column; nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column, kind = column.cast(pa.large_binary()), np.int64
    else:
        column, kind = column.cast(pa.binary()), np.int32
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of other than white space) and, for each row, the number of words before it."""
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    first[row_starts] = word[row_starts]
    last = word.copy()
    last[:-1] &= ~word[1:]
    row_ends = offsets[1:][offsets[1:] > 0] - 1
    last[row_ends] = word[row_ends]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)

"""Texts as arrays: bytes and words of whole Arrow batches, and hashes of their runs.

A batch's texts lie end to end in one byte buffer, so everything here works on whole
chunks with numpy. Sums of powers give the identity of any run of symbols from two
lookups; arithmetic wraps at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: White space that ends a word: space and the controls from tab to carriage return.
_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_SOLID = np.ones(256, bool)
_SOLID[list(_SPACE)] = False

_draw = np.random.Generator(np.random.PCG64(20240501))
#: One random 64-bit value for each byte, twice.
BYTE_VALUES = _draw.integers(0, 2**64, (2, 256), dtype=U64)
#: The same with A-Z read as a-z.
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[:, 65:91] = BYTE_VALUES[:, 97:123]
_BASES = (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15)


class _Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self._base, self._inverse = base, pow(base, -1, 2**64)
        self.drop()

    def drop(self) -> None:
        self._up = self._down = np.ones(0, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            self._up, self._down = (self._table(x, size) for x in (self._base, self._inverse))
        return self._up[:n], self._down[:n]

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, U64)
        steps[0] = 1
        return np.cumprod(steps, dtype=U64)


_POWERS = tuple(_Powers(base) for base in _BASES)


def drop_powers() -> None:
    """Forget the powers; they grow again as needed."""
    for powers in _POWERS:
        powers.drop()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits of the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Runs:
    """Identities of runs of symbols: a run's value depends on its symbols alone."""

    def __init__(self, symbols: np.ndarray, family: int = 0):
        up, self._down = _POWERS[family](len(symbols) + 1)
        self._sums = np.empty(len(symbols) + 1, U64)
        self._sums[0] = 0
        np.cumsum(symbols * up[:-1], out=self._sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        value = (self._sums[start + size] - self._sums[start]) * self._down[start]
        return mixed(value + np.asarray(size).astype(U64))

    def every(self, size: int) -> np.ndarray:
        """Of the runs of one size at every start."""
        n = len(self._sums) - size
        if n <= 0:
            return np.empty(0, U64)
        return mixed((self._sums[size:] - self._sums[:n]) * self._down[:n] + U64(size))


class Chunk:
    """Some whole texts of a batch: ``data`` holds their bytes, ``bounds`` where each begins and ends."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first, self.data, self.bounds = first, data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def parts(self, size: int) -> Iterator[Chunk]:
        """The texts in order, in groups of about ``size`` bytes; a longer text is a group of its own."""
        first, bounds = 0, self.bounds
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
            last = min(last, len(self))
            a, b = bounds[first], bounds[last]
            yield Chunk(first, self.data[a:b], bounds[first : last + 1] - a)
            first = last

    def doc_of_bytes(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.bounds))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each word, and the text it is in. Words end at white space and with the text."""
        n = len(self.data)
        solid = _SOLID[self.data]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        before[self.bounds[:-1][self.bounds[:-1] < n]] = False
        after[self.bounds[1:][self.bounds[1:] > 0] - 1] = False
        starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
        return starts, ends, np.searchsorted(self.bounds, starts, "right") - 1

    def word_values(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        values = LOWER_VALUES if lower else BYTE_VALUES
        return Runs(values[0][self.data]).of(starts, ends - starts)


def _buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), bounds


def chunks(column: pa.Array | pa.ChunkedArray, size: int = 1 << 21) -> Iterator[Chunk]:
    """The texts in order, in groups of about ``size`` bytes; a longer text is a group of its own. NULL is empty."""
    if len(column) == 0:
        return
    data, bounds = _buffer(column)
    yield from Chunk(0, data, bounds).parts(size)


def run_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any of the columns."""
    n = len(sorted_columns[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for column in sorted_columns:
            new[1:] |= column[1:] != column[:-1]
    return new

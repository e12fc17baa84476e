"""Whole texts of an Arrow batch as flat byte arrays: words, window hashes, sliding minima.

All steps are numpy passes over the bytes of a few documents at a time (``chunks``), so a
task holds some tens of megabytes whatever the size of its partition.  Hashes are
polynomials modulo 2^64 whose word values are mixed non-linearly; where equality must
not rest on 64 bits, two lanes with different bases make 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
U64 = np.uint64

# Odd 64-bit bases of the polynomials, one per lane.
_BYTE_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_WORD_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def table(members: bytes) -> np.ndarray:
    """A lookup of 256 flags, true for the given bytes."""
    flags = np.zeros(256, dtype=bool)
    flags[list(members)] = True
    return flags


# White space that ends words: space and \t \n \v \f \r.
SPACES = table(b" \t\n\x0b\x0c\r")
# Everything below 128 but digits and lower-case letters.
NOT_ALNUM = table(bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122)))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.bases = (base, pow(base, -1, 1 << 64))
        self.values = (np.ones(1, U64), np.ones(1, U64))

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.values[0]) < n:
            grown = []
            for base in self.bases:
                steps = np.full(max(n, CHUNK_BYTES + 1), base, U64)
                steps[0] = 1
                grown.append(np.multiply.accumulate(steps))
            self.values = tuple(grown)
        return self.values[0][:n], self.values[1][:n]


_POWERS = {base: _Powers(base) for base in _BYTE_BASES + _WORD_BASES}
_BYTE_VALUES = [mix(np.arange(1, 257, dtype=U64) * U64(base)) for base in _BYTE_BASES]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base modulo 2^64, and of its inverse."""
    return _POWERS[_WORD_BASES[0]].upto(n)


def _prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _POWERS[base].upto(len(values))[0], out=out[1:])
    return out


def byte_prefix(data: np.ndarray, lane: int = 0) -> np.ndarray:
    """Prefix sums of the byte polynomial: hashes of any range come from two of them."""
    return _prefix(_BYTE_VALUES[lane][data], _BYTE_BASES[lane])


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Mixed hashes of the byte ranges [start, end)."""
    inverse = _POWERS[_BYTE_BASES[lane]].upto(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(U64))


def fixed_hash(prefix: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Mixed hashes of all byte ranges of one width, by start."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, U64)
    return mix((prefix[width:] - prefix[:n]) * _POWERS[_BYTE_BASES[lane]].upto(n)[1])


def window_hash(values: np.ndarray, width: int, lane: int = 0) -> np.ndarray:
    """Mixed hashes of ``width`` consecutive values, by start."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = _WORD_BASES[lane]
    prefix = _prefix(values, base)
    return mix((prefix[width:] - prefix[:n]) * _POWERS[base].upto(n)[1])


def sliding(op, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over each run of ``width`` values, by doubling."""
    n, done = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    out = values
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = op(out[: n], out[width - done : width - done + n])
    return out[:n]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of some rows: byte ranges and the rows' first words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES, fold: bool = False) -> None:
        """``offsets`` are those of the rows within ``data``, the first one 0."""
        self.data = LOWER[data] if fold else data
        self.offsets = offsets
        gap = breaks[self.data]
        before, after = np.ones(len(gap), bool), np.ones(len(gap), bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        filled = offsets[:-1] < offsets[1:]
        before[offsets[:-1][filled]] = True
        after[offsets[1:][filled] - 1] = True
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(after & ~gap) + 1
        #: first[r]:first[r + 1] are the words of row r
        self.first = np.searchsorted(self.start, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lane: int = 0) -> np.ndarray:
        return range_hash(byte_prefix(self.data, lane), self.start, self.end, lane)

    def starts(self, width: int) -> np.ndarray:
        """Flags of the words that begin a window of ``width`` words within their row."""
        return fits(self.first, width)


def fits(first: np.ndarray, width: int) -> np.ndarray:
    """Flags of positions from which ``width`` positions fit into their row."""
    counts = np.diff(first)
    n = int(first[-1])
    last = np.repeat(first[1:], counts)
    return np.arange(n) + width <= last


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Flags of the positions inside windows that begin at ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:-1]) > 0


def as_long(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))

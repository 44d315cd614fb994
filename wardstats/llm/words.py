"""Words of many texts at once, as spans and 64-bit hashes over one array of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_BASE, BLOCK + 1), _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of a word: all but the six blanks; or digits, letters and all above ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins; a null is empty."""
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    column = pc.fill_null(column, empty).cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and don't overlap.

    Prefix sums of byte values times powers, block by block; a span longer
    than a block is hashed block by block into one value.
    """
    out = np.zeros(len(starts), U64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + BLOCK, "right")), i)
        if j == i:  # longer than a block
            h = U64(0)
            for a in range(base, ends[i], BLOCK):
                part = _BYTE[data[a : min(a + BLOCK, ends[i])]]
                with np.errstate(over="ignore"):
                    h = mix(np.array([h * U64(_BASE) + (part * _UP[: len(part)]).sum(dtype=U64)]))[0]
            out[i] = h
            i += 1
            continue
        part = _BYTE[data[base : ends[j - 1]]]
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(part * _UP[: len(part)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * _DOWN[a]
        i = j
    return mix(out + (ends - starts).astype(U64))


class Words:
    """Words of a column of texts.

    ``data`` are the bytes (lower-cased A-Z if asked for), ``starts`` and ``ends``
    the words' spans, ``first[d]:first[d + 1]`` the words of text d, ``hashes``
    one value a word (unless not ``hashed``).
    """

    def __init__(self, column: pa.Array, letters: np.ndarray = NOT_BLANK, lower: bool = False, hashed: bool = True):
        data, self.offsets = text_bytes(column)
        self.data = LOWER[data] if lower else data
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = letters[data]
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        begins[cuts] = inside[1:-1][cuts]
        stops[cuts - 1] = inside[1:-1][cuts - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        if hashed:
            self.hashes = span_hashes(self.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, a: int, b: int) -> bytes:
        """Words a to b, one space between."""
        raw = self.data
        return b" ".join([raw[s:e].tobytes() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())])


_RUN_UP: dict[int, np.ndarray] = {}


def runs(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) and hashes of all runs of n words within one text."""
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    acc = np.zeros(total, U64)
    for k in range(n):
        acc = acc * U64(_BASE) + hashes[k : k + total]
    good = np.ones(total, bool)
    for f in first[1:-1]:  # runs over a text's end
        good[max(0, f - n + 1) : f] = False
    at = np.flatnonzero(good)
    return at, mix(acc[at] + U64(n))


def covered(starts: np.ndarray, lengths, total: int) -> np.ndarray:
    """True for each of ``total`` places inside any of the spans."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0


def maximal_runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

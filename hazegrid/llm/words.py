"""Words of Arrow text columns as 64-bit hashes, in NumPy, for the operators that work on words inside tasks.

Bytes are taken straight from the Arrow buffers and handled in pieces of whole documents of about PIECE bytes,
so that memory follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once, unless one document is longer.
PIECE = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.cumprod(np.full(4096, 0xD1342543DE82EF95, np.uint64))
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Space and the control characters from tab to carriage return; every other byte belongs to a word.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _places(n: int) -> np.ndarray:
    """Factors of the first n positions in a word."""
    if n <= len(_PLACE):
        return _PLACE
    return np.cumprod(np.full(n, 0xD1342543DE82EF95, np.uint64))


def texts(column: pa.Array | pa.ChunkedArray, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: number of its first row, its bytes (about `piece`), and where its rows begin and end in them. Null is empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        if not len(chunk):
            continue
        wide = chunk.cast(pa.large_string()).fill_null("")
        ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
        data = wide.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(wide):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + piece, "right")) - 1)
            yield row + lo, data[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo]
            lo = hi
        row += len(wide)


def words(data: np.ndarray, ends: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words in bytes whose rows begin and end at `ends`; where they start; and the row bounds among them.

    blank: for each byte, whether it stands between words. A row's end also ends a word.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    letter = ~blank
    first = letter.copy()
    first[1:] &= blank[:-1]
    at = ends[:-1][ends[:-1] < n]
    first[at] |= letter[at]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(len(ends), np.int64)
    inside = np.flatnonzero(letter)
    begins = np.searchsorted(inside, starts) if len(inside) != n else starts
    lengths = np.diff(np.append(begins, len(inside)))
    place = np.arange(len(inside)) - np.repeat(begins, lengths)
    hashes = np.add.reduceat(_BYTE[data[inside]] * _places(int(lengths.max()))[place], begins)
    return mixed(hashes + lengths.astype(np.uint64) * _STEP), starts, np.searchsorted(starts, ends)


def shingled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, by first word; the last n-1 runs are missing."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.zeros(m, np.uint64)
    factor = _STEP
    for k in range(n):
        out += hashes[k:k + m] * factor
        factor = np.uint64((int(factor) * 0xD1342543DE82EF95 | 1) & (1 << 64) - 1)
    return mixed(out)

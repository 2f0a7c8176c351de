"""Arrow and numpy helpers that several operators share.

Texts are handled as UTF-8 bytes straight from the Arrow buffers. Work goes in blocks of at most ``BLOCK`` bytes (or one
text, if that is longer), so the arrays of a task stay small however many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def keys(count: int, seed: int) -> np.ndarray:
    """``count`` fixed 64-bit constants of a seed."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(MULTIPLIER) + np.uint64(seed))


_BYTE = keys(256, 11)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """MULTIPLIER ** 0 .. n-1 modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, BLOCK + 1), MULTIPLIER, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes each, or of one row."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end
        at = end


def word_bounds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts that lie one after the other in ``data``; ``space`` marks other separators.

    Returns start and end of every word, and where each text's words begin (with the total at the end).
    """
    word = ~space[data]
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    full = ends > starts
    before[starts[full]] = False
    after[ends[full] - 1] = False
    begin, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    first = np.searchsorted(begin, np.append(starts, len(data)))
    return begin, end, first


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span, from one running sum over the block."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers(len(data)), dtype=np.uint64, out=sums[1:])
    # The span's own polynomial is moved to power 0, so that equal spans agree wherever they stand.
    return mix((sums[end] - sums[begin]) * _inverses(len(data))[begin] if len(data) else sums[end])


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every ``width`` bytes in a row; equal to ``span_hashes`` of the same bytes."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * powers(len(data)), dtype=np.uint64, out=sums[1:])
    n = len(data) - width + 1
    out = sums[width:] - sums[:-width]
    out *= _inverses(n)
    return mix(out)


_inverse = np.ones(1, np.uint64)


def _inverses(n: int) -> np.ndarray:
    """INVERSE ** 0 .. n-1 modulo 2 ** 64."""
    global _inverse
    if len(_inverse) < n:
        steps = np.full(max(n, BLOCK + 1), INVERSE, np.uint64)
        steps[0] = 1
        _inverse = np.cumprod(steps, dtype=np.uint64)
    return _inverse[:n]


def block_words(column: pa.Array, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes by block: (first row, end row, hashes, where each row's words begin)."""
    data, offsets = text_buffers(column)
    for at, end in blocks(offsets):
        low, high = int(offsets[at]), int(offsets[end])
        part = data[low:high]
        begin, stop, first = word_bounds(part, offsets[at:end] - low, offsets[at + 1 : end + 1] - low)
        yield at, end, span_hashes(part, begin, stop, lower), first


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row, by text, and where each text's shingles begin.

    A text of fewer words has its whole word sequence as its one shingle; a text without words has none.
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    factors = keys(width + 1, 5) | np.uint64(1)
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    text = np.repeat(np.arange(len(counts)), made)
    start = first[:-1][text] + np.arange(bounds[-1]) - bounds[:-1][text]
    size = np.minimum(counts[text], width)
    out = size.astype(np.uint64) * factors[width]
    for i in range(width):
        term = padded[start + i] * factors[i]
        out += term if (size > i).all() else np.where(size > i, term, np.uint64(0))
    return mix(out), bounds

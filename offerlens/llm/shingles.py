"""Shingle sets of texts as sorted 64-bit hashes, computed on whole Arrow buffers.

Words are hashed from prefix sums of a polynomial over the bytes (modulo 2^64), so the
work is a few array operations per block of text, whatever the number of words. Letters
A-Z count as lower case; a set holds the hashes of all runs of five words, or one hash of
the whole sequence for a text of fewer.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Bytes of text hashed at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POSITION = [_U(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(WIDTH)]

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += _U(32)
_LOWER += _U(1)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), (_BASE, _INVERSE)[which], dtype=np.uint64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return _powers[which][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[bounds[i]:bounds[i + 1]], and the word bounds of the texts."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    word = _IS_WORD[data]
    cuts = bounds[1:-1]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    first, last = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[data] * _power(0, len(data)), out=sums[1:])
    hashes = (sums[last + 1] - sums[first]) * _power(1, len(data))[first]
    return mix64(hashes + (last - first).astype(np.uint64) * _POSITION[1]), np.searchsorted(first, bounds)


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, bounds) of runs of texts; a missing text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BLOCK_BYTES, "right")) - 1)
        yield start, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of every text."""
    for start, data, bounds in blocks(texts):
        words, at = word_hashes(data, bounds)
        runs = np.zeros(max(len(words) - WIDTH + 1, 0), dtype=np.uint64)
        for k in range(WIDTH):
            runs += words[k : len(runs) + k] * _POSITION[k]
        runs = mix64(runs)
        for i in range(len(bounds) - 1):
            a, b = at[i], at[i + 1]
            if b - a >= WIDTH:
                found = np.sort(runs[a : b - WIDTH + 1])
                if len(found) > 1:
                    keep = np.empty(len(found), dtype=bool)
                    keep[0] = True
                    np.not_equal(found[1:], found[:-1], out=keep[1:])
                    found = found[keep]
            elif b > a:
                whole = np.zeros(1, dtype=np.uint64)
                for k in range(b - a):
                    whole += words[a + k : a + k + 1] * _POSITION[k]
                found = mix64(whole + _U(b - a))
            else:
                found = words[:0]
            yield start + i, found

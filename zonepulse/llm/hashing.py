"""Shingle hashes of many texts at once with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A word's hash is a polynomial of random numbers per byte, read off
running sums over the whole batch; a shingle's hash mixes those of its words. 64 bits throughout: two different
shingles agree with a chance of about 2**-64.
"""

import numpy as np
import pyarrow as pa

CHUNK = 4 << 20         # bytes hashed together; a longer text is a chunk of its own
_BASE = np.uint64(0x9E3779B97F4A7C15 & ~7 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its first byte, the byte behind it)."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _WHITE[raw], [True]]).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * _powers(_BASE, len(raw)), out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * _powers(_INVERSE, len(raw) + 1)[first] + (last - first).astype(np.uint64))
    return hashes, first, last


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, its first byte) of lower-cased bytes."""
    return hashed_words(data)[:2]


def _combined(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(len(hashes) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = mix(total + hashes[k:k + n] + np.uint64(k + 1))
    return total


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``size`` words; all words, if there are fewer; none
    without words."""
    data = b"\n".join(texts).lower()
    hashes, first = word_hashes(data)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(first, starts).tolist()
    whole = _combined(hashes, size)
    sets = []
    for a, b in zip(at, at[1:]):
        if b - a >= size:
            sets.append(np.unique(whole[a:b - size + 1]))
        else:
            sets.append(_combined(hashes[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return sets


def chunks(texts: list[bytes], most: int = CHUNK):
    """Slices (from, to) of about ``most`` bytes."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null: empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]

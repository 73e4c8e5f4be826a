"""Sets of word shingles of whole texts, hashed to 64 bits, and their sketches.

Words are runs of bytes other than blanks and the control characters 9 to 13, with A-Z
lower-cased; UTF-8 keeps these bytes apart from all others. A set holds the distinct runs
of `width` words; a text of fewer words is one run, a text without words has none.
"""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 20
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _chunk_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first positions of the words; `breaks` are positions where a text begins."""
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at_break = breaks[inside[breaks]]
    begins[at_break] = True
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, dtype=np.uint64), first
    place = np.arange(len(data)) - np.repeat(np.append(0, first), np.diff(np.concatenate([[0], first, [len(data)]])))
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE))
    value = _VALUE[data] * powers[place]
    value[~inside] = 0
    return mixed(np.add.reduceat(value, first)), first


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and per text where its words end in them.

    Memory is bounded by a chunk of text at a time, or by one word where that is longer.
    """
    hashes, at, start = [], [], 0
    while start < len(data):
        stop = min(start + _CHUNK, len(data))
        if stop < len(data):
            blank = np.flatnonzero(_BLANK[data[start:stop]])
            text = offsets[np.searchsorted(offsets, stop, side="right") - 1]
            cut = max(start + int(blank[-1]) if len(blank) else 0, int(text))
            if cut <= start:
                blank = np.flatnonzero(_BLANK[data[stop:]])[:1]
                text = offsets[np.searchsorted(offsets, stop, side="right")]
                cut = min(stop + int(blank[0]) if len(blank) else len(data), int(text))
            stop = cut
        low, high = np.searchsorted(offsets, [start, stop])
        found, first = _chunk_words(data[start:stop], offsets[low:high] - start)
        hashes.append(found)
        at.append(first + start)
        start = stop
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
    return hashes, np.searchsorted(at, offsets[1:])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, ends = words(data, offsets)
    runs = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for i in range(width):
        runs += hashes[i : len(hashes) - width + 1 + i] * _PLACE[i]
    runs = mixed(runs)
    out, begin = [], 0
    for end in ends.tolist():
        if end - begin >= width:
            out.append(np.unique(runs[begin : end - width + 1]))
        elif end > begin:
            short = hashes[begin:end]
            out.append(mixed((short * _PLACE[width : width + len(short)]).sum(keepdims=True) + _U(len(short))))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        begin = end
    return out


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit numbers per set that equal sets share, as signed numbers."""
    out = np.zeros((len(sets), 2), dtype=np.uint64)
    for i, s in enumerate(sets):
        out[i] = mixed(s + _U(1)).sum(), mixed(s ^ _U(0xD6E8FEB86659FD93)).sum()
    return mixed(out).view(np.int64)


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """`count` 32-bit minhashes of each set; all ones for an empty set."""
    rng = np.random.Generator(np.random.PCG64(7))
    masks = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    factors = rng.integers(0, 1 << 63, count, dtype=np.uint64) * _U(2) + _U(1)
    out = np.full((len(sets), count), 0xFFFFFFFF, dtype=np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        joined = np.concatenate([sets[i] for i in full])
        begins = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for k in range(count):
            out[full, k] = np.minimum.reduceat(((joined ^ masks[k]) * factors[k]) >> _U(32), begins)
    return out

"""Word shingles and circulant MinHash signatures of Arrow text batches, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5  # words of a shingle
CHUNK = 1 << 20  # bytes of text worked on at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64) | np.uint64(1)
_SHORT = _rng.integers(1, 2**63, WIDTH, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers (two rounds of multiply and shift)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_powers = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    """The first n powers of the base, kept for the next batch."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words before each of ``begins`` (and in all)."""
    data = _LOWER[data]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = begins[:-1][begins[:-1] < len(data)]
    first[starts] = inside[starts]
    at = np.flatnonzero(first)
    before = np.searchsorted(at, begins)
    if not len(at):
        return np.zeros(0, np.uint64), before
    place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data)))) if at[0] == 0 else None
    if place is None:
        data, inside = data[at[0] :], inside[at[0] :]
        at = at - at[0]
        place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data))))
    value = _BYTE[data] * _power(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mix(np.add.reduceat(value, at)), before


def _long(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one long text, a stretch of about CHUNK bytes at a time; stretches end behind white space."""
    found, at = [], 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            while not len(gaps) and end < len(data):  # a word that goes on
                gaps = np.flatnonzero(_SPACE[data[end : end + CHUNK]]) + (end - at)
                end += CHUNK
            end = at + int(gaps[-1]) + 1 if len(gaps) else len(data)
        part = data[at:end]
        found.append(_words(part, np.array([0, len(part)]))[0])
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array):
    """For every text, in order: the sorted distinct 64-bit hashes of its shingles.

    Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A text of fewer than five words has one
    shingle, its whole word sequence; one without words, or null, has none.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        low, high = offsets[at], offsets[upto]
        if high - low > CHUNK:
            words = _long(data[low:high])
            before = np.array([0, len(words)])
        else:
            words, before = _words(data[low:high], offsets[at : upto + 1] - low)
        n = len(words)
        rolled = np.zeros(max(0, n - WIDTH + 1), dtype=np.uint64)
        for j in range(WIDTH):
            rolled += words[j : j + len(rolled)] * _PLACE[j]
        rolled = mix(rolled)
        for a, b in zip(before[:-1], before[1:]):
            k = int(b - a)
            if k >= WIDTH:
                yield np.unique(rolled[a : b - WIDTH + 1])
            elif k:
                whole = _SHORT[k : k + 1].copy()
                for j in range(k):
                    whole += words[a + j : a + j + 1] * _PLACE[j]
                yield mix(whole)
            else:
                yield np.zeros(0, np.uint64)
        at = upto


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least image under P of the k-fold circular shift of S(shingles).

    S and P are two fixed bijections of the 32-bit numbers; only these two permutations are needed for any ``size``.
    """
    once = shingles ^ (shingles >> np.uint64(32))
    once = once.astype(np.uint32)  # the universe of shingles
    once ^= once >> np.uint32(16)
    once *= np.uint32(0x7FEB352D)
    once ^= once >> np.uint32(15)
    once *= np.uint32(0x846CA68B)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    best = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, (1 << 16) // size)
    for a in range(0, len(once), step):
        z = once[None, a : a + step] + shifts
        z *= np.uint32(0x2C1B3C6D)
        z ^= z >> np.uint32(15)
        z *= np.uint32(0x297A2D39)
        z ^= z >> np.uint32(16)
        np.minimum(best, z.min(axis=1), out=best)
    return best


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates; the band's number is part of it."""
    parts = sig[: len(sig) // rows * rows].reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(parts), dtype=np.uint64) + np.uint64(1)
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return key

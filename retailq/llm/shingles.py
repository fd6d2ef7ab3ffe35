"""Word shingles of many texts at a time as 64-bit hashes, computed over the texts' bytes with numpy."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(256, 0x100000001B3 | 1, np.uint64), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lowered, words between bytes 0x20 and 0x09-0x0D) and the number of words of each text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] |= inside[cuts]
    of_text = np.searchsorted(offsets, np.flatnonzero(begins), side="right") - 1
    counts = np.bincount(of_text, minlength=len(texts)) if len(of_text) else np.zeros(len(texts), np.int64)
    letters = _LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    starts = np.flatnonzero(begins[inside])
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = np.diff(starts, append=len(letters))
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    # Words beyond 256 bytes go on with a scrambled power for each further 256, so every byte has its own weight.
    weight = _POWERS[place & 255]
    if lengths.max() > 256:
        weight = weight * (mix((place >> 8).astype(np.uint64)) | np.uint64(1))
    return mix(np.add.reduceat(letters * weight, starts) + lengths.astype(np.uint64) * _ODD), counts


def shingle_sets(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, laid end to end, and their number for each text.

    A text of fewer words than ``size`` has its whole sequence as one shingle; one without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        runs = runs * _ODD + words[i:i + len(runs)]
    runs = mix(runs)
    sets, sizes = [np.zeros(0, np.uint64)], np.zeros(len(counts), np.int64)
    for row, (end, count) in enumerate(zip(ends.tolist(), counts.tolist())):
        if count >= size:
            found = np.unique(runs[end - count:end - size + 1])
        elif count:
            whole = np.uint64(count)
            for word in words[end - count:end]:
                whole = mix(np.array([whole]) * _ODD + word)[0]
            found = np.array([whole], np.uint64)
        else:
            continue
        sets.append(found)
        sizes[row] = len(found)
    return np.concatenate(sets), sizes


def min_hashes(sets: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """(texts with a set, count) of 16-bit MinHash values, for the texts whose set is not empty."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.zeros((len(starts), count), np.uint16)
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * _ODD)
    for k in range(count if len(starts) else 0):
        least = np.minimum.reduceat((sets ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1)), starts)
        out[:, k] = mix(least) >> np.uint64(48)
    return out

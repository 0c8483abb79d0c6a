"""Words of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Hashes are polynomials over the bytes modulo 2**64, mixed with the length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of a word, and the multipliers of the SplitMix64 finaliser.
SPACES = b" \t\n\x0b\x0c\r"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.uint64(0xBF58476D1CE4E5B9)
SECOND = np.uint64(0x94D049BB133111EB)

#: Bytes hashed in one numpy step, and the length from which a word is hashed by itself.
BLOCK_BYTES, LONG_WORD = 1 << 20, 1 << 15

IS_SPACE = np.isin(np.arange(256), list(SPACES))
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A"):ord("Z") + 1] += 32
PLAIN = np.arange(256, dtype=np.uint64)
with np.errstate(over="ignore"):
    POWERS = np.cumprod(np.full(LONG_WORD + 1, np.uint64(0x100000001B3) * GOLDEN | np.uint64(1)), dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of the values over 64 bits."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= FIRST
    values ^= values >> np.uint64(27)
    values *= SECOND
    values ^= values >> np.uint64(31)
    return values


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end and the offsets of each; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    edge[-1] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = PLAIN) -> np.ndarray:
    """Hash of each word; ``letters`` maps bytes before hashing."""
    lengths = ends - starts
    hashes = np.empty(len(starts), np.uint64)
    cut = np.minimum(lengths, LONG_WORD)
    before = np.concatenate([[0], np.cumsum(cut)])
    first = 0
    with np.errstate(over="ignore"):
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(before, before[first] + BLOCK_BYTES, "right")) - 1)
            sizes, own = cut[first:last], before[first:last] - before[first]
            within = np.arange(before[last] - before[first]) - np.repeat(own, sizes)
            values = letters[data[within + np.repeat(starts[first:last], sizes)]]
            values = (values + np.uint64(1)) * POWERS[within]
            hashes[first:last] = np.add.reduceat(values, own)
            first = last
        hashes = mix(hashes + lengths.astype(np.uint64) * GOLDEN)
    for place in np.flatnonzero(lengths > LONG_WORD):
        word = letters[data[starts[place]:ends[place]]].astype(np.uint8).tobytes()
        hashes[place] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes


def windows(hashes: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside a text, and the index of the first of each text.

    A text with some words but fewer than ``width`` has one window, all its words.
    """
    counts = np.diff(firsts)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - firsts[:-1], sizes)
    left = np.repeat(firsts[1:], sizes) - places
    total = np.zeros(len(places), np.uint64)
    with np.errstate(over="ignore"):
        for step in range(width):
            total = mix(total * FIRST + GOLDEN)
            taken = step < left
            total[taken] += hashes[places[taken] + step]
        return mix(total), bounds

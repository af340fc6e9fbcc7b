"""Words of Arrow text columns as numpy arrays: no Python object per word.

The bytes of a column are cut into slices of about a quarter of a megabyte. Slices end
between texts, or inside a very long text at the end of a word, so memory
stays bounded while every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
_STEP = np.uint64(0xD6E8FEB86659FD93)

#: The six white-space bytes of ASCII.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but letters; bytes of longer code points count as letters.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _STEP
    h = (h ^ (h >> _SHIFT)) * _STEP
    return h ^ (h >> _SHIFT)


@dataclass
class Words:
    """Words of one slice: ``data[start:end]`` belongs to row ``row``; rows run from ``first`` to ``last`` inclusive.

    ``hash`` and ``check`` are two independent hashes of a word's (folded) bytes.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    check: np.ndarray
    first: int
    last: int


#: Places of a word whose numbers are looked up; those of later ones are computed.
_NEAR = 64


def _number(place: np.ndarray, byte: np.ndarray, seed: int) -> np.ndarray:
    """A number that looks random for each byte at each place of a word."""
    return mix(mix((place.astype(np.uint64) << np.uint64(8) | byte) + np.uint64(seed)) * _ODD)


_SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
_TABLES = tuple(_number(np.repeat(np.arange(_NEAR), 256), np.tile(np.arange(256, dtype=np.uint64), _NEAR), s) for s in _SEEDS)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each word: sums of numbers of its bytes and their places, and of its length.

    Every byte counts, NUL too, and a number depends on byte and place alone, so
    words with the same hash are no more likely for texts of any kind.
    """
    length = end - start
    flat = data[ragged(start, length)] if len(start) else data[:0]
    ends = np.cumsum(length)
    place = np.arange(len(flat)) - np.repeat(ends - length, length)
    far = np.flatnonzero(place >= _NEAR)
    slot = (np.minimum(place, _NEAR - 1) << 8) | flat
    out = []
    for table, seed in zip(_TABLES, _SEEDS):
        numbers = table[slot]
        if len(far):
            numbers[far] = _number(place[far], flat[far].astype(np.uint64), seed)
        total = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(numbers, out=total[1:])
        out.append(mix(total[ends] - total[ends - length] + length.astype(np.uint64) * _ODD))
    return out[0], out[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def word_slices(column: pa.Array, gaps: np.ndarray = SPACE, fold: np.ndarray | None = None) -> Iterator[Words]:
    """Every word of every row, with two 64-bit hashes of its (folded) bytes."""
    offsets, data = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        at, stop = offsets[row], max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        if stop > row + 1 or offsets[stop] - at <= SLICE_BYTES:
            yield _words(data[at : offsets[stop]], offsets[row : stop + 1] - at, row, gaps, fold)
        else:
            while at < offsets[stop]:
                end = min(at + SLICE_BYTES, offsets[stop])
                while end < offsets[stop]:  # to the next gap, so that no word is cut
                    found = np.flatnonzero(gaps[data[end : min(end + SLICE_BYTES, offsets[stop])]])
                    end = end + found[0] if len(found) else min(end + SLICE_BYTES, offsets[stop])
                    if len(found):
                        break
                yield _words(data[at:end], np.array([0, end - at]), row, gaps, fold)
                at = end
        row = stop


def _words(data: np.ndarray, bounds: np.ndarray, first: int, gaps: np.ndarray, fold: np.ndarray | None) -> Words:
    n = len(data)
    inside = ~gaps[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashed, check = word_hashes(data if fold is None else fold[data], start, end)
    row = np.searchsorted(bounds[:-1], start, "right") - 1
    return Words(data, start, end, row + first, hashed, check, first, first + len(bounds) - 2)


def words_by_row(column: pa.Array, gaps: np.ndarray = SPACE, fold: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """One array of word hashes for each row, in order."""
    parts: list[np.ndarray] = []
    at = 0
    for words in word_slices(column, gaps, fold):
        if words.first > at:
            yield np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            parts, at = [], at + 1
        cuts = np.searchsorted(words.row, np.arange(words.first, words.last + 2))
        for k in range(words.last - words.first):
            parts.append(words.hash[cuts[k] : cuts[k + 1]])
            yield np.concatenate(parts) if len(parts) > 1 else parts[0]
            parts, at = [], at + 1
        parts.append(words.hash[cuts[-2] : cuts[-1]])
    if len(column):
        yield np.concatenate(parts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)

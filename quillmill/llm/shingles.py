"""Word shingles of whole texts as 64-bit hashes, computed over Arrow buffers without a Python loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of about so many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
_JOIN = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted and without repeats."""
    x = np.sort(x)
    return x[np.concatenate([x[:1] == x[:1], x[1:] != x[:-1]])]


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """For each byte: a random 64-bit value, the same for A-Z as for a-z; and whether it is white space."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    values[65:91] = values[97:123]
    space = np.zeros(256, dtype=bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    return values, space


_VALUES, _SPACE = _byte_values()
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse; kept up to a run's length."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    out = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (_BASE, _UNBASE)]
    if n <= 2 * RUN_BYTES:
        _POWERS[:] = out
    return out[0], out[1]


def runs(column: pa.Array):
    """(first row, rows, bytes, offsets from 0) for runs of a string column; nulls are empty."""
    column = pa.concat_arrays([column]) if column.offset else column
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + RUN_BYTES, "right")) - 1)
        yield i, j - i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, bounds): the words of a run; those of text i are bounds[i] to bounds[i + 1].

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's hash is a polynomial over random byte
    values modulo 2^64, taken from prefix sums.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first[edges] = inside[edges]  # a word never goes on into the next text
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(len(offsets), np.int64)
    power, unpower = _powers(len(data) + 1)
    prefix = np.empty(len(data) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(np.where(inside, _VALUES[data], np.uint64(0)) * power[:-1], out=prefix[1:])
    ends = np.append(starts[1:], len(data))  # white space up to the next word adds nothing
    return mix((prefix[ends] - prefix[starts]) * unpower[starts]), starts, np.searchsorted(starts, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts a text): the shingles of each text of a run, repeats included.

    A text with 1 to width - 1 words is one shingle. A shingle's hash combines its words' and how many there are.
    """
    n = len(offsets) - 1
    words, _, bounds = word_hashes(data, offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    n_words = np.diff(bounds)
    counts = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    text = np.repeat(np.arange(n), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = bounds[:-1][text] + nth
    taken = np.minimum(n_words, width)[text].astype(np.uint64)
    out = mix(taken)
    for k in range(width):
        has = k < taken
        out = np.where(has, (out + words[np.minimum(at + k, len(words) - 1)]) * _JOIN, out)
    return mix(out), counts


def shingle_sets(column: pa.Array, width: int = 5):
    """(row, sorted distinct hashes) for each text of a string column."""
    for row, rows, data, offsets in runs(column):
        hashes, counts = shingle_hashes(data, offsets, width)
        ends = np.cumsum(counts)
        for k in range(rows):
            yield row + k, distinct(hashes[ends[k] - counts[k] : ends[k]])

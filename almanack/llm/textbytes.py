"""Words of whole columns of text as 64-bit numbers, on numpy arrays of bytes.

Arrow hands a column of strings to Python as one array of UTF-8 bytes and one of
offsets.  The functions here find and hash all words of many rows at a time, so no
Python code runs per word.  A chunk holds whole rows of about ``CHUNK`` bytes; one
longer row makes a chunk of its own.
"""

import numpy as np
import pyarrow as pa

CHUNK = 2 << 20

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x):
    """A finaliser: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_VALUE = mixed(_LOWER.astype(U) * U(0x9E3779B97F4A7C15) + U(0x632BE59BD9B4E019))
_POWER = np.cumprod(np.full(4096, 0x5851F42D4C957F2D, U))


def _class(separators):
    word = np.ones(256, bool)
    for first, last in separators:
        word[first : last + 1] = False
    return word


#: letters, digits and everything beyond ASCII
ALNUM = _class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: everything but white space
SOLID = _class([(0x20, 0x20), (0x09, 0x0D)])


def column_bytes(column):
    """The bytes and the row offsets of an Arrow column of text; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def chunks(column, limit=CHUNK):
    """(first row, last row + 1, bytes, offsets from 0), lower-cased in A-Z, in order."""
    data, at = column_bytes(column)
    rows, first = len(at) - 1, 0
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(rows, max(last, first + 1))
        yield first, last, _LOWER[data[at[first] : at[last]]], at[first : last + 1] - at[first]
        first = last


def word_bounds(x, at, word):
    """Starts and ends of the words in ``x``; no word crosses a row."""
    inside = word[x]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = at[:-1][at[1:] > at[:-1]]
    first[full] = inside[full]
    ends = at[1:][at[1:] > at[:-1]] - 1
    last[ends] = inside[ends]
    return inside, np.flatnonzero(first), np.flatnonzero(last) + 1


def words(x, at, word):
    """(hash of each word, offsets of the rows' words)."""
    inside, starts, ends = word_bounds(x, at, word)
    of_row = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, U), of_row
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    value = _VALUE[x[inside]] * _POWER[place & 4095]
    return mixed(np.add.reduceat(value, before) + lengths.astype(U)), of_row


def runs(sorted_values):
    """Starts of the runs of equal values, and their lengths."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    starts = np.concatenate(([0], edge))
    return starts, np.diff(np.concatenate((starts, [len(sorted_values)])))

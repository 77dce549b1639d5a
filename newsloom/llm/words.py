"""Words and stretches of text as 64-bit hashes, computed on whole Arrow buffers.

Helpers for tasks: they turn the bytes of a slice of a string column into arrays
with one entry for each word, so that no Python object is made for a word.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_PLACE = np.uint64(0x9E3779B97F4A7C15)
_LENGTH = np.uint64(0xD1B54A32D192ED03)
#: The low bytes of a word of eight, by their number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def lower_case() -> np.ndarray:
    """Each byte, A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


@cache
def word_bytes(punctuation: bool) -> np.ndarray:
    """Which bytes belong to words; without ``punctuation`` ASCII signs separate, too."""
    table = np.ones(256, bool)
    table[list(BLANKS)] = False
    if not punctuation:
        for b in range(0x80):
            if not chr(b).isalnum():
                table[b] = False
    return table


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``most`` bytes; a longer row stands alone.

    NULL counts as the empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words; no word goes on into the next row."""
    flag = np.zeros(len(data) + 2, bool)
    flag[1:-1] = inside[data]
    body = flag[1:-1]
    starts = body & ~flag[:-2]
    ends = body & ~flag[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    starts[cut] |= body[cut]
    ends[cut - 1] |= body[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def eights(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each span, eight to a number, and how many numbers each has (one for an empty span)."""
    lengths = ends - starts
    counts = np.maximum((lengths + 7) >> 3, 1)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at_byte = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    if (counts == 1).all():
        return at_byte[starts] & _LOW[lengths], counts
    within = _within(counts)
    return at_byte[np.repeat(starts, counts) + 8 * within] & _LOW[np.minimum(np.repeat(lengths, counts) - 8 * within, 8)], counts


def _within(counts: np.ndarray) -> np.ndarray:
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def hash_eights(values: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: its numbers are mixed, each with its place, and then added.

    Mixing is not linear, so unlike the value of a polynomial the sum does not cancel out
    for texts that are made for it.
    """
    if not len(counts):
        return np.zeros(0, np.uint64)
    mixed = mix(values)
    if len(values) > len(counts):
        mixed = np.add.reduceat(mix(mixed + _within(counts).astype(np.uint64) * _PLACE), np.cumsum(counts) - counts)
    else:
        mixed = mix(mixed)
    return mix(mixed + lengths.astype(np.uint64) * _LENGTH)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; with ``lower``, A-Z count as a-z."""
    if lower:
        data = lower_case()[data]
    values, counts = eights(data, starts, ends)
    return hash_eights(values, counts, ends - starts)


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True, punctuation: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a slice and, for each row, where its words begin (one entry more than rows)."""
    starts, ends = spans(data, offsets, word_bytes(punctuation))
    return span_hashes(data, starts, ends, lower), np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)

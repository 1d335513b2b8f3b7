"""Hashes of words and word shingles, computed on Arrow text buffers.

A column of texts is one byte buffer with offsets. Words are found and hashed on that
buffer with whole-array operations, so no Python object is made per word. All hashes are
64-bit and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21  # texts are handled in blocks of about this size, so memory is bounded
WIDTH = 5

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, size: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit words."""
    steps = np.arange(1, size + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    return mix(steps + mix(np.array([seed], dtype=U64)))


BYTES = stream(1, 256)
PLACES = stream(2, 256) | U64(1)
FAR_PLACES = stream(3, 4096) | U64(1)
FAR_PLACES[0] = 1  # short words hash alike in a block with and without long ones
STEPS = stream(4, WIDTH) | U64(1)

_codes = np.arange(256)
_upper = (_codes >= 65) & (_codes <= 90)
SPACE = (_codes == 32) | ((_codes >= 9) & (_codes <= 13))
NOT_WORD = (_codes < 128) & ~(
    ((_codes >= 48) & (_codes <= 57)) | _upper | ((_codes >= 97) & (_codes <= 122))
)


def byte_values(separators: np.ndarray) -> np.ndarray:
    """Hash values of bytes: A-Z count as a-z, separators as nothing."""
    values = BYTES[np.where(_upper, _codes + 32, _codes)].copy()
    values[separators] = 0
    return values


SPACE_VALUES = byte_values(SPACE)
WORD_VALUES = byte_values(NOT_WORD)


def text_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``BLOCK_BYTES``; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offsets_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = int(offsets[first]), int(offsets[last])
        yield first, data[low:high], offsets[first : last + 1] - low
        first = last


def words(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, values: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in order, and where each text's words begin (and the last end)."""
    if data.size == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    text_starts = offsets[:-1][np.diff(offsets) > 0]
    begins[text_starts] = inside[text_starts]
    starts = np.flatnonzero(begins)
    if starts.size == 0:
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    lead = starts[0]
    spans = np.diff(np.append(starts, data.size))
    place = np.arange(lead, data.size) - np.repeat(starts, spans)
    weighted = values[data[lead:]] * PLACES[place & 255]
    if spans.max() > 256:
        weighted *= FAR_PLACES[(place >> 8) & 4095]
    hashes = mix(np.add.reduceat(weighted, starts - lead))
    return hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and where each text's shingles begin.

    A text with fewer words than ``width`` has its whole sequence as one shingle, a text
    without words none.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    edges = np.concatenate(([0], np.cumsum(made)))
    total = int(edges[-1])
    if total == 0:
        return np.zeros(0, U64), edges
    at = np.arange(total) - np.repeat(edges[:-1], made) + np.repeat(bounds[:-1], made)
    size = np.minimum(np.repeat(counts, made), width)
    padded = np.append(hashes, np.zeros(width, U64))
    steps = STEPS if width <= WIDTH else stream(4, width) | U64(1)
    total_hash = size.astype(U64) * U64(0x9FB21C651E98DF25)
    for j in range(width):
        part = padded[at + j] * steps[j]
        if j:
            part = np.where(j < size, part, U64(0))
        total_hash = total_hash + part
    return mix(total_hash), edges


def text_shingles(column: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, bounds per text) in blocks; words end at white space."""
    for first, data, offsets in text_blocks(column):
        hashes, bounds = words(data, offsets, SPACE, SPACE_VALUES)
        grams, edges = shingles(hashes, bounds, width)
        yield first, grams, edges

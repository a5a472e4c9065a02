"""Splitting Arrow batches of texts into words, array-wise.

Work is done on the UTF-8 bytes of a slice of texts: a table of 256 flags says which bytes
belong to words. Bytes over 0x7F always do, so a character is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

# Words are [^\x20\x09-\x0D]+, or [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z is lower case.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def release() -> None:
    """Give memory that a batch has left free back to the system: workers live on through many tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice has more than ``limit`` bytes of text, or else one row."""
    if not batch.num_rows:
        return
    values = batch.column(batch.schema.get_field_index(column))
    sizes = np.nan_to_num(np.asarray(pc.binary_length(values).to_numpy(zero_copy_only=False), float))
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the place of each text in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values between each two bounds."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Words:
    """Words of a slice of texts: their bytes in a row, and where words and texts begin."""

    data: np.ndarray  # bytes of the words, without what stands between them
    at: np.ndarray  # place of each word in data, and the end
    texts: np.ndarray  # number of the first word of each text, and the end
    starts: np.ndarray  # place of each word in the texts' bytes

    @property
    def n(self) -> int:
        return len(self.at) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.texts)

    @cached_property
    def encoded(self) -> pa.DictionaryArray:
        at = pa.py_buffer(self.at.astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), self.n, [None, at, pa.py_buffer(self.data)]).dictionary_encode()

    @cached_property
    def codes(self) -> np.ndarray:
        """A number for each word, equal for equal words of the slice."""
        return self.encoded.indices.to_numpy(zero_copy_only=False)

    @cached_property
    def vocabulary(self) -> list[bytes]:
        """The word of each number."""
        return self.encoded.dictionary.to_pylist()

    def spaced(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with a blank after each, and where each word begins and ends."""
        long = np.diff(self.at)
        number = np.arange(self.n)
        joined = np.full(len(self.data) + self.n, 32, np.uint8)
        joined[np.arange(len(self.data)) + np.repeat(number, long)] = self.data
        begin = self.at[:-1] + number
        return joined.tobytes(), begin, begin + long


def split_words(texts: pa.Array, inside: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    data, bounds = text_bytes(texts)
    if lower:
        data = LOWER[data]
    word = inside[data]
    before = np.zeros(len(word), bool)
    before[1:] = word[:-1]
    before[bounds[:-1][bounds[:-1] < len(word)]] = False
    starts = np.flatnonzero(word & ~before)
    place = np.cumsum(word, dtype=np.int64)
    kept = data[word]
    at = np.append(place[starts] - 1, len(kept)) if len(starts) else np.zeros(1, np.int64)
    return Words(kept, at, np.searchsorted(starts, bounds), starts)


def shingle_spans(texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word of every shingle, and the first shingle of each text and the end.

    A text of fewer words than ``size``, but not none, is one shingle.
    """
    counts = np.diff(texts)
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    first = np.arange(bounds[-1]) - np.repeat(bounds[:-1], per_text) + np.repeat(texts[:-1], per_text)
    return first, np.minimum(first + size, np.repeat(texts[1:], per_text)) - 1, bounds


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalising hash of unsigned numbers."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return values ^ (values >> np.uint64(32))

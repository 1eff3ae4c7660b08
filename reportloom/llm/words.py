"""Words of whole texts as arrays of codes, for operators that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa

SLICE_BYTES = 8 << 20  # text worked on at once; a longer text is a slice of its own
SPACE = 32


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Maps each byte to itself, separators to a blank, and A-Z to lower case if asked. UTF-8 above ASCII stays."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = SPACE
    return table


#: Words between ASCII white space, lower-cased or as they are.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACED = byte_table(BLANKS)
SPACED_AS_IS = byte_table(BLANKS, lower=False)
#: Words of ASCII digits, ASCII letters and everything above ASCII, lower-cased.
ALPHANUMERIC = byte_table(bytes([*range(0, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


class Words(NamedTuple):
    codes: np.ndarray  # of each word, its place in values
    values: pa.Array  # distinct words
    bounds: np.ndarray  # the words of row i are codes[bounds[i]:bounds[i + 1]]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def split_words(texts: pa.Array, table: np.ndarray) -> Words:
    """Cuts texts at the blanks that the table makes. A null text has no words."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or ends[-1] == ends[0]:
        return Words(np.empty(0, np.int64), pa.array([], pa.string()), np.zeros(len(texts) + 1, np.int64))
    data = table[np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]]
    ends -= ends[0]
    inside = data != SPACE
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = ends[:-1][ends[:-1] < len(data)]
    first[row_starts] = inside[row_starts]
    starts = np.flatnonzero(first)
    kept = np.concatenate(([0], np.cumsum(inside)))
    offsets = np.append(kept[starts], kept[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.searchsorted(starts, ends))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about limit bytes."""
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64))
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += int(size)
    if start < len(texts):
        yield start, len(texts)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a bounded amount of text, empty ones left out."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if len(texts):
            for a, b in slices(texts.cast(pa.string()), limit):
                yield batch.slice(a, b - a)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of a well-known public hash)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_hashes(values: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    if not len(values):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per row out of flat values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, kind))

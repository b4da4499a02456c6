"""Words of Arrow batches of texts, found in bulk over their UTF-8 bytes: all classes of characters here are unions of ASCII
characters and of everything beyond ASCII, so that bytes decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from varloom.llm.shingles import _BYTE, _upto, mix

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes looked at together: as many texts as fit, or one longer text; and bytes hashed together.
CHUNK, HASHED = 8 << 20, 1 << 20


def byte_class(*ranges: tuple[int, int], beyond: bool = True) -> np.ndarray:
    """Which bytes stand in the ranges (ends included), or beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    table[128:] |= beyond
    return table


@dataclass
class Words:
    """The words of some texts in order: letters without what is between them, and where they are."""

    letters: np.ndarray  # A-Z as a-z
    offsets: np.ndarray  # n + 1
    text: np.ndarray  # of each word, from 0 in the batch
    starts: np.ndarray  # bytes from the start of the chunk
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.text)

    def strings(self) -> pa.LargeStringArray:
        return pa.LargeStringArray.from_buffers(len(self), pa.py_buffer(self.offsets), pa.py_buffer(self.letters))

    def hashes(self) -> np.ndarray:
        """64 bits for each word; equal words have equal ones."""
        out, at, n = np.empty(len(self), dtype=np.uint64), 0, len(self)
        while at < n:
            end = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + HASHED, side="right")) - 1)
            part = self.letters[self.offsets[at] : self.offsets[end]]
            o = self.offsets[at : end + 1] - self.offsets[at]
            power, unpower = _upto(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
            out[at:end] = mix((sums[o[1:]] - sums[o[:-1]]) * unpower[o[:-1]])
            at = end
        return out


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a column of texts; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), at


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, bytes and offsets from 0 of runs of texts."""
    data, at = raw(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def find_words(data: np.ndarray, at: np.ndarray, inside: np.ndarray, first: int = 0) -> Words:
    """The words, longest runs of the bytes `inside`, of the texts that lie at the offsets `at` of data."""
    within = inside[data]
    begin, end = within.copy(), within.copy()
    begin[1:] &= ~within[:-1]
    end[:-1] &= ~within[1:]
    heads = at[:-1][at[:-1] < at[1:]]
    begin[heads] = within[heads]
    tails = heads[heads > 0] - 1
    end[tails] = within[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return Words(_LOWER[data[within]], offsets, np.searchsorted(at, starts, side="right") - 1 + first, starts, ends)

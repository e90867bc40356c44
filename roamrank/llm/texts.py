"""Texts of an Arrow batch as one array of bytes, and their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words with more bytes are hashed one by one.
LONG = 256


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a binary array without nulls, and where each text begins and ends in them."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def portions(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts with ``size`` bytes of a column each, or one longer text."""
    _, starts, ends = buffer_of(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + size, side="right")))
        yield batch.slice(low, high - low)
        low = high


class Words:
    """The words of a batch's texts: runs of bytes that aren't separators, within one text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, separators: bytes) -> None:
        table = np.ones(256, bool)
        table[np.frombuffer(separators, np.uint8)] = False
        inside = table[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        some = ends > starts
        at, to = starts[some], ends[some] - 1
        first[at] = inside[at]
        last[to] = inside[to]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: The first word of each text, and the number of all words.
        self.bounds = np.concatenate([np.searchsorted(self.starts, starts), [len(self.starts)]])
        self.lengths = self.ends - self.starts
        self.bytes = data[inside]
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])

    def __len__(self) -> int:
        return len(self.starts)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the words by number."""
        buffers = [None, pa.py_buffer(self.places), pa.py_buffer(np.ascontiguousarray(self.bytes))]
        listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), buffers)
        found = listed.dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False), found.dictionary

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight of its bytes at a time."""
        padded = np.concatenate([self.bytes, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(self.bytes) + 1, "<u8", padded.data, 0, (1,))
        turn, masks = np.uint64(0x9E3779B97F4A7C15), np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        out = self.lengths.astype(np.uint64) * turn
        rest, at, left = np.arange(len(self)), self.places[:-1], self.lengths
        while len(rest):
            mixed = out[rest] ^ eight[at] & masks[np.minimum(left, 8)]
            mixed = (mixed ^ mixed >> np.uint64(32)) * turn
            out[rest] = mixed ^ mixed >> np.uint64(29)
            on = (left > 8) & (left <= LONG)
            rest, at, left = rest[on], at[on] + 8, left[on] - 8
        for place in np.flatnonzero(self.lengths > LONG):
            own = self.bytes[self.places[place] : self.places[place + 1]]
            out[place] = xxhash.xxh3_64_intdigest(own.tobytes())
        return out

    def spaced(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and where each begins."""
        begins = self.places + np.arange(len(self) + 1)
        out = np.full(int(begins[-1]), 32, np.uint8)
        kept = np.ones(len(out), bool)
        kept[begins[1:] - 1] = False
        out[kept] = self.bytes
        return out.tobytes(), begins

"""Ragged numpy views of a batch of texts: words, lines and sums per text without a Python loop over characters."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
# Bytes of text handled at a time; one longer text is a slice of its own.
SLICE_BYTES = 2_500_000


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


IS_SPACE = byte_set(SPACES)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers alive between stages, and several share a machine."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose texts hold about `limit` bytes."""
    lengths = np.array([0 if n is None else n for n in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    group = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Number of each string among the distinct ones, and these."""
    if len(offsets) <= 1:
        return np.zeros(0, np.int64), pa.array([], pa.large_binary())
    coded = binary_array(data, offsets).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring offsets; 0 where there are none."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def take_ranges(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pool[start : start + length] of every range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` neighbours; runs may cross texts, the caller leaves those out."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out + hashes[k : k + n] + np.uint64(k))
    return out


class Texts:
    """Words of a batch of texts. A word is a run of characters other than ASCII white space."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, self.offsets = flat(column)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.count = data, len(self.offsets) - 1
        self.white = IS_SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[self.offsets] = True
        inside = ~self.white
        edge = first.copy()
        edge[1:] |= np.concatenate((self.white, [True]))[:-1] if len(data) else True
        self.starts = np.flatnonzero(inside & edge[: len(data)])
        edge = first[1:].copy()
        edge[: max(0, len(data) - 1)] |= self.white[1:]
        self.ends = np.flatnonzero(inside & edge) + 1
        # Word numbers at which each text begins.
        self.word_offsets = np.searchsorted(self.starts, self.offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    @cached_property
    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.count), self.n_words)

    @cached_property
    def _coded(self) -> tuple[np.ndarray, pa.Array]:
        lengths = self.ends - self.starts
        return encode(self.data[~self.white], np.concatenate(([0], np.cumsum(lengths))))

    @property
    def ids(self) -> np.ndarray:
        return self._coded[0]

    @property
    def vocabulary(self) -> pa.Array:
        return self._coded[1]

    @cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, alike in every batch and on every machine."""
        digest = xxhash.xxh3_64_intdigest
        known = np.fromiter((digest(w) for w in self.vocabulary.to_pylist()), np.uint64, len(self.vocabulary))
        return known[self.ids] if len(known) else np.zeros(0, np.uint64)

    def window_starts(self, size: int) -> np.ndarray:
        """Word numbers at which a window of `size` words of one text begins."""
        last = np.repeat(self.word_offsets[1:], self.n_words) - size
        at = np.arange(len(self.starts))
        return at[at <= last]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Number among distinct lines, and text, of every line that has a word."""
        if not len(self.data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        feed = self.data == 10
        starts = np.unique(np.concatenate((self.offsets[:-1], np.flatnonzero(feed) + 1)))
        starts = starts[starts < len(self.data)]
        feeds = np.concatenate(([0], np.cumsum(feed)))
        bounds = np.concatenate((starts, [len(self.data)]))
        ids, _ = encode(self.data[~feed], bounds - feeds[bounds])
        worded = sums(~self.white, bounds) > 0
        doc = np.searchsorted(self.offsets, starts, "right") - 1
        return ids[worded], doc[worded]

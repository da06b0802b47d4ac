"""Words of many texts at once, as numpy arrays over the bytes of an Arrow string column.

A word is a run of bytes other than 0x20 and 0x09-0x0D, so words are the same for bytes and code points.  A word's
64-bit hash is a polynomial over random per-byte values, taken as a difference of running sums, so the whole column is
hashed without a Python loop.  Hashes depend on nothing but the bytes; two different words share one with odds of 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Breaks at ASCII marks too, for texts compared without their punctuation.
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(i).isalnum() for i in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_P = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}
#: Bytes or words whose running sums are taken at once; a longer word is taken alone.
CHUNK = 1 << 17


def lean(run: Callable) -> Callable:
    """A pass over batches that gives its freed memory back to the system at its end: workers stay for the next tasks."""

    @wraps(run)
    def passed(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # no such call in this C library
                pass

    return passed


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, base % 2**64, np.uint64)
        steps[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(steps)
    return have[:n]


class Texts:
    """A slice of texts: ``data`` holds their bytes, ``offsets`` where each begins; nulls are empty.

    Word arrays: ``hashes``, ``starts`` and ``ends`` (byte positions), and ``first`` (each text's first word; one more
    entry ends the last)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks: np.ndarray = _SPACE):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        word = ~breaks[data]
        begin, end = word.copy(), word.copy()
        if n:
            begin[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            cut = offsets[(offsets > 0) & (offsets < n)]
            begin[cut] = word[cut]
            end[cut - 1] = word[cut - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.hashes = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):  # runs of whole words, so that running sums stay short
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + CHUNK, "right")))
            size = self.ends[to - 1] - low
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(_BYTE[self.data[low : low + size]] * _powers(_P, size), out=sums[1:])
            a, b = self.starts[at:to] - low, self.ends[at:to] - low
            self.hashes[at:to] = mix((sums[b] - sums[a]) * _powers(pow(_P, -1, 2**64), size + 1)[a])
            at = to
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_words(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self)), self.n_words)

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the kept words, each followed by one space, and where each text's part begins."""
        size = (self.ends - self.starts + 1) * keep
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts[keep]] += 1
        inside[self.ends[keep]] -= 1
        mask = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        at = np.concatenate([[0], np.cumsum(size)])
        out = np.full(at[-1], 0x20, np.uint8)
        space = np.zeros(at[-1], bool)
        space[at[1:][keep] - 1] = True
        out[~space] = self.data[mask]
        return out, at[self.first]


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each word, as if the texts were one; the last k-1 are left out."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    base, out = 0xD1342543DE82EF95, np.empty(m, np.uint64)
    for at in range(0, m, CHUNK):
        some = hashes[at : at + CHUNK + k - 1]
        sums = np.zeros(len(some) + 1, np.uint64)
        np.cumsum(some * _powers(base, len(some)), out=sums[1:])
        out[at : at + CHUNK] = mix((sums[k:] - sums[:-k]) * _powers(pow(base, -1, 2**64), len(some) - k + 1))
    return out


def inside(first: np.ndarray, k: int, m: int) -> np.ndarray:
    """Which of the m k-grams lie within one text."""
    ok = np.zeros(m, bool)
    delta = np.zeros(m + 1, np.int64)
    n = np.diff(first)
    have = n >= k
    np.add.at(delta, first[:-1][have], 1)
    np.add.at(delta, first[1:][have] - k + 1, -1)
    ok[:] = np.cumsum(delta[:-1]) > 0
    return ok


def column(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary Arrow array; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text at most; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, offsets = column(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def texts(batch: pa.RecordBatch, text: str = "text", lower: bool = False, breaks: np.ndarray = _SPACE) -> Texts:
    return Texts(*column(batch.column(batch.schema.get_field_index(text))), lower=lower, breaks=breaks)

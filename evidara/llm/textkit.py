"""Words, lines and their 64-bit hashes, taken from a whole Arrow batch of texts at once with numpy.

A word is a run of bytes other than space and 0x09-0x0D of the UTF-8 text. Hashes are polynomials modulo 2**64 over a
fixed random table, finished with a 64-bit mixer; two different words of a corpus of n distinct words share a hash with
a chance of about n**2 / 2**65.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: For words that are runs of ASCII letters, digits and all bytes beyond ASCII.
IS_MARK = np.ones(256, bool)
IS_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64 - 1, 512, dtype=np.uint64)
LINE_TABLE = _RANDOM[:256].copy()
LINE_TABLE[0x0A] = 0
WORD_TABLE = _RANDOM[256:].copy()
WORD_TABLE[IS_SPACE] = 0
LOWER_WORD_TABLE = WORD_TABLE[LOWER]
_STEP = U(0x9E3779B97F4A7C15)
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """The first n powers of an odd constant modulo 2**64."""
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([[U(1)], np.cumprod(np.full(max(n, 4096) * 2, _STEP, U))])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, applied to each element."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a string column, and len + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets is not None else np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]] if len(at) else data, at - (at[0] if len(at) else 0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into runs of rows with about `most` bytes of text: (rows, bytes, offsets)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of a task's batches, after whose end the worker gives memory back that it has freed, as it may serve other tasks later."""

    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return wrapped


def trim() -> None:
    """Gives memory back that this process has freed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


class Words:
    """The words of a slice: start and end bytes, the text each lies in, and per text the range [first, last) of its words."""

    def __init__(self, data: np.ndarray, at: np.ndarray, gaps: np.ndarray = IS_SPACE):
        self.data, self.at, self.gaps = data, at, gaps
        n, texts = len(data), len(at) - 1
        ink = ~gaps[data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.zeros(n, bool)
        before[1:] = ink[:-1]
        before &= ~edge[:n]
        self.start = np.flatnonzero(ink & ~before)
        after = np.zeros(n, bool)
        after[:-1] = ink[1:]
        after &= ~edge[1:]
        self.end = np.flatnonzero(ink & ~after) + 1
        self.first = np.searchsorted(self.start, at[:-1])
        self.last = np.searchsorted(self.start, at[1:])
        self.count = self.last - self.first
        self.text = np.repeat(np.arange(texts), self.count)
        self.ink = ink

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash of each word; with `lower`, of the word with A-Z lower-cased."""
        table = LOWER_WORD_TABLE if lower else WORD_TABLE
        if self.gaps is not IS_SPACE:
            table = np.where(self.gaps, U(0), table)
        return mix(spans(self.data, self.start, table)) if len(self.start) else np.zeros(0, U)

    def windows(self, h: np.ndarray, k: int, across: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of k words that lie in one text, or with `across` of all, and each window's first word."""
        if len(h) < k:
            return np.zeros(0, U), np.zeros(0, np.int64)
        at = np.flatnonzero(across | (self.text[: len(h) - k + 1] == self.text[k - 1 :]))
        out = h[at]
        for i in range(1, k):
            out = out * _STEP + h[at + i]
        return mix(out), at


#: Bytes that `spans` hashes at once, so that a long text needs little more memory than itself and numbers stay in the processor's cache.
SPAN_BYTES = 1 << 15


def spans(data: np.ndarray, start: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of table[byte] * step ** place over the runs that begin at `start` and reach to the next start."""
    out = np.empty(len(start), U)
    first = 0
    while first < len(start):
        last = max(first + 1, int(np.searchsorted(start, start[first] + SPAN_BYTES, "right")) - 1)
        lead, until = int(start[first]), int(start[last]) if last < len(start) else len(data)
        if until - lead > SPAN_BYTES and last - first == 1:
            out[first] = long_span(data[lead:until], table)
        elif until - lead > 2 * SPAN_BYTES:  # the rest of the data, whose last run is long
            last -= 1
            out[first:last] = short_spans(data[lead : int(start[last])], start[first:last] - lead, table)
        else:
            out[first:last] = short_spans(data[lead:until], start[first:last] - lead, table)
        first = last
    return out


def short_spans(data: np.ndarray, start: np.ndarray, table: np.ndarray) -> np.ndarray:
    """`spans` for runs that cover `data`."""
    length = np.diff(start, append=len(data))
    place = np.arange(len(data))
    place -= np.repeat(start, length)
    # only a run's bytes up to its last nonzero entry matter, and they're next to its start
    values = table[data]
    values *= powers(int(length.max()))[place]
    return np.add.reduceat(values, start)


def long_span(data: np.ndarray, table: np.ndarray) -> np.uint64:
    """`spans` for one run of any length, in parts."""
    total, factor, step = 0, 1, pow(int(_STEP), SPAN_BYTES, 1 << 64)
    for a in range(0, len(data), SPAN_BYTES):
        part = data[a : a + SPAN_BYTES]
        total += int(np.add.reduce(table[part] * powers(len(part))[: len(part)])) * factor
        factor = factor * step % (1 << 64)
    return U(total % (1 << 64))


def sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of `flags` over the ranges between neighbouring offsets."""
    if len(at) == 2:
        return np.array([np.count_nonzero(flags[at[0] : at[1]])])
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column from values in order and each row's count."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))

"""Words of whole Arrow text columns as 64-bit hashes, with numpy over the column's bytes.

A word's hash is a polynomial of its bytes modulo 2^64, taken from prefix sums, then mixed. Texts are worked
through in slices of about SLICE bytes that end between words, so memory is bounded for texts of any length.
"""

from __future__ import annotations

import ctypes
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_M = (1 << 64) - 1
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def fold_table(separators=SPACE, lower=True, maps: dict[int, int] | None = None) -> np.ndarray:
    """Byte table: separators become 0, A-Z lower case, further bytes as ``maps`` says."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    for a, b in (maps or {}).items():
        t[a] = b
    t[0] = 255  # NUL bytes stay part of a word
    t[list(separators)] = 0
    return t


WORDS = fold_table()
LINES = fold_table((0x0A, 0x0D), lower=False)

_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        if size > 4 * SLICE:
            return tables[0], tables[1]  # for one huge word; not kept
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    hash: np.ndarray  # uint64 of every word
    start: np.ndarray  # first byte, in the column's bytes
    end: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]
    offsets: np.ndarray  # bytes of text i are offsets[i]:offsets[i + 1]
    data: np.ndarray  # the column's bytes
    prefixes: tuple  # hashes of the first k bytes, for the k asked for (0 where the word is shorter)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def _slices(data, offsets, table):
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        hi = lo + SLICE
        if hi >= end:
            hi = end
        else:
            cut = int(offsets[np.searchsorted(offsets, hi, "right") - 1])
            if cut > lo:
                hi = cut
            else:  # within one long text: after its last separator, or else at the next one
                stop = int(offsets[np.searchsorted(offsets, hi, "right")])
                back = np.flatnonzero(table[data[lo:hi]] == 0)
                if len(back):
                    hi = lo + int(back[-1]) + 1
                else:
                    while hi < stop:
                        ahead = np.flatnonzero(table[data[hi : min(hi + SLICE, stop)]] == 0)
                        if len(ahead):
                            hi += int(ahead[0]) + 1
                            break
                        hi = min(hi + SLICE, stop)
        yield lo, hi
        lo = hi


def words(column, table: np.ndarray = WORDS, prefix_bytes: tuple = (), parts: np.ndarray | None = None) -> Words:
    """``parts`` (a class for each byte) also ends words between classes 2 and 3, and leaves bytes of class 4 alone."""
    data, offsets = text_bytes(column)
    hashes, starts, ends = [], [], []
    heads = [[] for _ in prefix_bytes]
    for lo, hi in _slices(data, offsets, table):
        b = table[data[lo:hi]]
        n = hi - lo
        full = b != 0
        before = np.empty(n, bool)
        before[0], before[1:] = False, full[:-1]
        edges = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "left")] - lo
        before[edges] = False
        if parts is not None:
            kind = parts[data[lo:hi]]
            a, z = kind[:-1], kind[1:]
            edge = np.flatnonzero(((a != z) & (a > 1) & (z > 1)) | (a == 4) | (z == 4)) + 1
            before[edge] = False
        s = np.flatnonzero(full & ~before)
        after = np.empty(n, bool)
        after[-1], after[:-1] = False, full[1:]
        after[edges[edges > 0] - 1] = False
        if parts is not None:
            after[edge - 1] = False
        e = np.flatnonzero(full & ~after) + 1
        power, inverse = _power_tables(n)
        sums = np.empty(n + 1, np.uint64)
        sums[0] = 0
        np.cumsum(b * power[:n], out=sums[1:])
        at = inverse[s]
        hashes.append(mix((sums[e] - sums[s]) * at))
        for k, out in zip(prefix_bytes, heads):
            long = e - s >= k
            stop = np.where(long, s + k, s)
            out.append(np.where(long, mix((sums[stop] - sums[s]) * at), np.uint64(0)))
        starts.append(s + lo)
        ends.append(e + lo)

    def join(parts, kind):
        return np.concatenate(parts) if parts else np.zeros(0, kind)

    start = join(starts, np.int64)
    return Words(
        join(hashes, np.uint64), start, join(ends, np.int64), np.searchsorted(start, offsets), offsets, data,
        tuple(join(x, np.uint64) for x in heads),
    )


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def release() -> None:
    """Freed memory goes back to the system. Otherwise a worker process, which lives on for all later tasks, keeps what its largest slice took."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches, text: int, most: int = 4 << 20):
    """Arrow batches in slices of about ``most`` bytes of text, one text at least. What a slice took is released after it."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end
            release()


def constants(n: int, seed: int = 1) -> np.ndarray:
    """n odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64((seed * 0xD1342543DE82EF95 + 1) & _M)) | np.uint64(1)


def sequences(h: np.ndarray, width: int, take: tuple | None = None) -> np.ndarray:
    """Hash of every run of ``width`` words; with ``take``, of the words at these places of the run only."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = constants(width)
    out = np.zeros(n, np.uint64)
    for k in range(width) if take is None else take:
        out += h[k : k + n] * c[k]
    return mix(out)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text's words; a shorter text is one shingle, an empty one has none."""
    if len(h) == 0:
        return np.zeros(0, np.uint64)
    if len(h) < width:
        return mix(np.array([(h * constants(len(h), 7 + len(h))).sum()], np.uint64))
    return np.unique(sequences(h, width))

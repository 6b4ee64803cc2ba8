"""Helpers inside tasks: whole texts of an Arrow batch as flat numpy arrays, without a loop over words.

A word is a run of ``[^\\x20\\x09-\\x0D]`` of the whole text. A null text counts as empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text that are handled at once; a longer text is a batch of its own.
SLICE_BYTES = 4 << 20
HASH_BYTES = 1 << 20
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offsets of the texts in them, one more than texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    if data is None or not data.size:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of adjacent slices of the bytes."""
    if len(offsets) < 2:
        return pa.array([], pa.large_string())
    buffers = [pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, *buffers)


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of text, so that long texts don't meet in one batch."""
    for batch in batches:
        _, ends = flat(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()  # the worker stays for other tasks


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; the input is overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out)


@dataclass
class Words:
    """Words of several texts: text t has the words ``first[t]`` to ``first[t + 1]``, word i the bytes ``start[i]`` to ``end[i]``."""

    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes with ``inside``, none across texts: first run of each text, starts, ends."""
    solid = np.zeros(len(data) + 1, bool)
    solid[:-1] = inside
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[offsets[:-1]] = solid[offsets[:-1]]
    starts = np.flatnonzero(begins)
    stops = ~solid
    stops[1:] &= solid[:-1]
    stops[offsets[1:-1]] |= solid[offsets[1:-1] - 1] & (offsets[1:-1] > 0)
    stops[0] = False
    return np.searchsorted(starts, offsets), starts, np.flatnonzero(stops)


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Words with a 64-bit hash of each; A-Z count as a-z if ``lower``."""
    data, offsets = flat(texts)
    first, start, end = runs(data, offsets, ~byte_table(SPACES)[data])
    return Words(first, start, end, slice_hashes(lower_table()[data] if lower else data, start, end))


def slice_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of the bytes, alike wherever the slice stands. Starts and ends rise.

    Sums of bytes times powers, of about ``HASH_BYTES`` at a time, so that the numbers for each byte stay few.
    """
    value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
    out = np.empty(len(start), np.uint64)
    begin, there, back = 0, powers(_BASE, 0), powers(1, 0)
    while begin < len(start):
        base = start[begin]
        stop = max(begin + 1, int(np.searchsorted(end, base + HASH_BYTES, side="right")))
        part = value[data[base : end[stop - 1]]]
        if len(part) >= len(back):
            there, back = powers(_BASE, len(part)), powers(pow(_BASE, -1, 2**64), len(part) + 1)
        part *= there[: len(part)]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=total[1:])
        s, e = start[begin:stop] - base, end[begin:stop] - base
        out[begin:stop] = mixed((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64))
        begin = stop
    return out


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` neighbours that lies within one text, and the window's first position."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(size, n + size) <= ends)
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value = mixed((value ^ hashes[at + k]) + np.uint64(_STEP))
    return value, at


def distinct_by_text(values: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of each text."""
    out = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        own = np.sort(values[begin:end])
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([np.zeros(1, np.asarray(values).dtype if np.asarray(values).dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def crc32_mod(ids: Iterable, modulus: int) -> np.ndarray:
    """Remainder of the crc32 of each id as text; a null id counts as the text ''."""
    return np.fromiter((zlib.crc32(b"" if i is None else str(i).encode()) % modulus for i in ids), np.int64)

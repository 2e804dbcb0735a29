"""Vectorised word and byte views of Arrow text batches, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from stratum.llm.text import SPACES

#: Odd multiplier of the rolling hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
KEYS = ("stratum-window-1", "stratum-window-2")


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose texts hold at most ``most_bytes`` together (one row at least).

    A worker lives on between tasks, so the memory that a batch needed is given back after it."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): the words of row i are words[offsets[i]:offsets[i + 1]]; null texts have none."""
    text = pc.utf8_trim(pc.fill_null(text.cast(pa.large_string()), ""), SPACES)
    parts = pc.split_pattern_regex(text, r"[\x20\x09-\x0D]+")
    counts = np.diff(parts.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = parts.flatten()
    empty = pc.equal(text, "").to_numpy(zero_copy_only=False)
    if empty.any():
        keep = np.repeat(~empty, counts)
        flat = flat.filter(pa.array(keep))
        counts = np.where(empty, 0, counts)
    return np.concatenate([[0], np.cumsum(counts)]), flat


def word_hashes(words: pa.Array, keys: tuple[str, ...] = KEYS) -> list[np.ndarray]:
    """One 64-bit hash array for each key; each distinct word is hashed once."""
    if len(words) == 0:
        return [np.zeros(0, np.uint64) for _ in keys]
    coded = words.dictionary_encode()
    values = np.asarray(coded.dictionary.to_numpy(zero_copy_only=False), dtype=object)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return [pd.util.hash_array(values, hash_key=(k + "-" * 16)[:16], categorize=False)[codes] for k in keys]


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (rolling, modulo 2**64)."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(n, BASE), out=sums[1:])
    out = sums[width:] - sums[:-width]
    out *= powers(n - width + 1, BASE_INVERSE)
    return out


def inside(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, row, position) of the windows of ``width`` that lie within one row."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    position = np.arange(len(row)) - first[row] if len(row) else np.zeros(0, np.int64)
    return offsets[:-1][row] + position if len(row) else np.zeros(0, np.int64), row, position


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length and 8-byte items as compressed bytes (differences, byte planes)."""
    planes = []
    for a in arrays:
        a = a.astype(np.int64, copy=False).view(np.uint64)
        delta = np.diff(a, prepend=np.uint64(0))
        planes.append(delta.view(np.uint8).reshape(-1, 8).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, n_arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // 8 // n_arrays
    out = []
    for k in range(n_arrays):
        plane = raw[k * 8 * n:(k + 1) * 8 * n].reshape(8, n).T
        out.append(np.cumsum(np.ascontiguousarray(plane).view(np.uint64).reshape(-1)).view(np.int64))
    return out


def runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, length) of the maximal runs of consecutive starts; input sorted by (doc, start)."""
    if len(doc) == 0:
        return doc, start, start
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    return doc[at], start[at], np.diff(np.append(at, len(doc)))


def groups(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    if len(values):
        edges = np.append(np.flatnonzero(np.append(True, values[1:] != values[:-1])), len(values))
        yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def next_prime(n: int) -> int:
    n = max(2, n)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n

"""Texts of an Arrow batch as word hashes, and window hashes over them.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Null text has no words. All arrays of a batch are flat, with document offsets.
"""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           nbytes: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``nbytes`` of text and at most ``rows`` rows (at least one),
    so that working memory follows the slice and the longest text, not the batch."""
    try:
        yield from _slices(batches, text, nbytes, rows)
    finally:
        give_back()


def give_back() -> None:
    """Return free memory to the system: an idle worker would keep what its largest slice took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):          # another C library
        pass


def _slices(batches: Iterator[pa.RecordBatch], text: str, nbytes: int,
            rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // nbytes + np.arange(batch.num_rows) // rows
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and for document i the places offsets[i] to offsets[i + 1]."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not full.all():          # white space at an end of a text leaves an empty string there
        kept = np.concatenate([[0], np.cumsum(full)])
        flat, offsets = flat.filter(pa.array(full)), kept[offsets]
    return flat, offsets


def hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and document offsets."""
    flat, offsets = split(texts)
    return of_words(flat), offsets


def of_words(flat: pa.Array) -> np.ndarray:
    if len(flat) == 0:
        return np.zeros(0, np.uint64)
    coded = pc.dictionary_encode(flat)
    digest = xxhash.xxh3_64_intdigest
    table = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), np.uint64,
                        len(coded.dictionary))
    return table[coded.indices.to_numpy(zero_copy_only=False)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(h: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of the n items from each place on (places that run over the end are left out)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, done, power, width, shift = None, 0, h, 1, np.uint64(base | 1)
    with np.errstate(over="ignore"):
        while True:
            if n & width:       # out covers ``done`` items; put ``width`` more behind them
                out = power if out is None else (
                    out[:len(power) - done] * shift + power[done:][:len(out)])
                done += width
            if width * 2 > n:
                break
            power = power[:len(power) - width] * shift + power[width:]
            shift = shift * shift
            width *= 2
        return mix(out[:len(h) - n + 1])


def inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Places at which a window of n items stays within its document."""
    total = int(offsets[-1])
    ok = np.ones(max(total - n + 1, 0), bool)
    for k in range(1, n):       # the last n - 1 places of every document
        at = offsets[1:] - k
        at = at[(at >= offsets[:-1]) & (at < len(ok))]
        ok[at] = False
    return np.flatnonzero(ok)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Document number of every item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def crc32(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    data = memoryview(values.astype("<u4").tobytes())
    return np.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets, offsets[1:])], np.int64)

"""Vectorised work on the UTF-8 bytes of Arrow string columns: words, hashes, shingles. A null text is an empty one."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Text bytes that are handled at once; a longer text is handled alone.
SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (shift, multiply, shift)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
STEP = U(0x9E3779B97F4A7C15)
UNSTEP = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and grown by doubling."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, U)
        have[0] = 1
        _powers[int(base)] = have = np.cumprod(have)
    return have[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n+1 offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


_libc = ctypes.CDLL(None)


def give_back() -> None:
    """Return freed memory to the machine: Python workers live on after their task, beside those of later stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `most` bytes of text, or one row; gives memory back after the last one."""
    for batch in batches:
        if isinstance(batch, pa.Table):
            yield from slices(iter(batch.to_batches()), column, most)
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lens.astype(np.int64))
        at = 0
        while at < len(lens):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, to - at)
            at = to
    give_back()


def lower_latin1(data: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Lower-case in `out` the capitals of Latin-1 (UTF-8 C3 80-9E) that stand in `data`."""
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
    out[capital] += 32
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    c = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_CODES[data] * powers(STEP, len(data)), out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the byte strings [start, end), from prefix_sums; equal strings at any place hash alike."""
    return mix((c[end] - c[start]) * powers(UNSTEP, len(c))[start] + (end - start).astype(U))


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes other than 0x20 and 0x09-0x0D), and the first word of each row (n+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    ink = ~SPACE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    at = off[:-1][off[:-1] < off[1:]]
    first[at] = ink[at]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    to = off[1:][off[:-1] < off[1:]] - 1
    last[to] = ink[to]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lower-cased, and the first word of each row (n+1)."""
    start, end, rows = word_spans(data, off)
    return span_hash(prefix_sums(LOWER[data]), start, end), rows


def shingle_sets(words: np.ndarray, rows: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, ascending, and their offsets (n+1). A row of fewer words is one shingle; of none, empty."""
    counts = np.diff(rows)
    n = len(counts)
    acc = np.zeros(max(0, len(words) - width + 1), U)
    for j in range(width):
        acc += words[j : len(words) - width + 1 + j] * powers(UNSTEP, 2 * width + 1)[2 * j + 1]
    acc = mix(acc)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_off = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(out_off[-1], U)
    full = np.flatnonzero(counts >= width)
    if len(full):
        take = np.repeat(rows[full] - out_off[full], sizes[full])
        slots = ranges(out_off[full], sizes[full])
        out[slots] = acc[slots + take]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        h = counts[r : r + 1].astype(U)
        for j in range(rows[r], rows[r + 1]):
            h = mix(h * STEP + words[j : j + 1])
        out[out_off[r]] = h[0]
    for a, b in zip(out_off[full], out_off[full + 1]):
        out[a:b].sort()
    fresh = np.ones(len(out), bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[out_off[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[out_off]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start[i], start[i] + size[i])."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def row_of(off: np.ndarray) -> np.ndarray:
    """The row number of each element, from n+1 offsets."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending hashes: the numbers of the non-empty equal ranges of hash values, and their offsets."""
    width = U((1 << 64) // buckets + 1) if buckets > 1 else None
    b = (h // width).astype(np.int64) if width else np.zeros(len(h), np.int64)
    at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else np.zeros(0, np.int64)
    return b[at], np.append(at, len(b))


def blobs(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def joined(column: pa.Array, dtype) -> np.ndarray:
    """All values of a column of packed arrays, one after another."""
    return np.frombuffer(raw_binary(column)[0], dtype)


def raw_binary(column: pa.Array) -> tuple[bytes, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    values = column.to_pylist()
    return b"".join(v or b"" for v in values), np.cumsum([0, *(len(v or b"") for v in values)])

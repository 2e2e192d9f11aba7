"""Vectorised text helpers for Arrow tasks: words and hashes over UTF-8 bytes.

Everything works on the concatenated bytes of a few rows at a time, so memory
is a small multiple of ``MAX_BYTES`` or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_BYTES = 512 << 10

#: words are separated by ASCII white space
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII letters to lower case, other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows in one array, and the n + 1 row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def small_batches(batches, column: str, max_bytes: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices with at most ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row number of every word, in order."""
    if data.size == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~_SPACE[data]
    edge = np.zeros(data.size + 1, bool)
    edge[offs] = True
    first = solid & edge[:-1]
    first[1:] |= solid[1:] & ~solid[:-1]
    last = solid & edge[1:]
    last[:-1] |= solid[:-1] & ~solid[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (xor-shift-multiply finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.up.size < n:
            steps = np.full(n, _P, np.uint64)
            steps[0] = 1
            cls.up = np.multiply.accumulate(steps)
            steps[1:] = _P_INV
            cls.down = np.multiply.accumulate(steps)
        return cls.up, cls.down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: a polynomial by prefix sums, scrambled."""
    if starts.size == 0:
        return np.zeros(0, np.uint64)
    up, down = _Powers.get(data.size + 1)
    prefix = np.zeros(data.size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:data.size], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix64(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def window_hashes(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``size`` consecutive words of one row.

    ``rows`` ascends. Rows with fewer words than ``size`` give none.
    """
    n = hashes.size - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keep = rows[:n] == rows[size - 1:]
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = mix64(total ^ (hashes[k:k + n] + np.uint64(k + 1)))
    return total[keep], rows[:n][keep]

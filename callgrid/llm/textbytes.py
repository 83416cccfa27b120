"""Texts as byte arrays: whole Arrow batches are cut into words, hashed and shingled without a loop over words.

Words are maximal runs of bytes other than space and 0x09-0x0D. Those bytes never occur inside a UTF-8 sequence, so
words of bytes are words of code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2 << 20
U = np.uint64
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_X = U(0x9E3779B97F4A7C15)
_X_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_HASH = mixed(np.arange(1, 257, dtype=U) * _X)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
_powers: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base of the polynomial hash, or of its inverse."""
    have = _powers.get(int(inverse))
    if have is None or len(have) < n:
        base = np.full(max(n, PIECE_BYTES + 1), _X_INVERSE if inverse else _X, dtype=U)
        base[0] = 1
        have = np.multiply.accumulate(base)
        if n <= 4 * PIECE_BYTES:
            _powers[int(inverse)] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (null: empty) and the bounds of its rows in them."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(bounds) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES):
    """(rows, bytes, bounds) with at most `limit` bytes of the column each, or one longer row."""
    for batch in batches:
        buf, bounds = text_bytes(batch.column(column))
        at, n = 0, batch.num_rows
        even = -(-len(buf) // max(1, -(-len(buf) // limit)))  # no small rest
        while at < n:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + even, "right")) - 1)
            to = min(to, n)
            yield batch.slice(at, to - at), buf[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
            at = to


def words(buf: np.ndarray, bounds: np.ndarray, is_break: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it (one more at the end).

    Words are maximal runs of bytes that are no break; `is_break` says so for each of the 256 bytes.
    """
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~is_break[buf]
    new = np.ones(len(buf) + 1, bool)
    new[1:-1] = ~inside[:-1]
    new[bounds] = True  # a row's end, and the start of the next
    starts = np.flatnonzero(inside & new[:-1])
    last = np.ones(len(buf) + 1, bool)
    last[1:-1] = ~inside[1:]
    last[bounds] = True
    ends = np.flatnonzero(inside & last[1:]) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def run_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes [start, end).

    Every eight bytes are mixed by themselves with their place, so that no structure of a text cancels out, as it can in
    sums of bytes times powers of a base. The length is mixed in with the first eight.
    """
    if not len(starts):
        return np.zeros(0, U)
    eight = np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]).data, strides=(1,))
    size = ends - starts
    h = mixed((eight[starts] & _LOW_BYTES[np.minimum(size, 8)]) + size.astype(U) * _X)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8
        after = np.cumsum(more)
        nth = np.arange(1, after[-1] + 1) - np.repeat(after - more, more)
        at = np.repeat(starts[long], more) + 8 * nth
        left = np.repeat(ends[long], more) - at
        part = mixed((eight[at] & _LOW_BYTES[np.minimum(left, 8)]) ^ mixed(nth.astype(U) * _X))
        h[long] = mixed(h[long] + np.add.reduceat(part, after - more))
    return h


def shingles(hashes: np.ndarray, per_row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k-word shingles (a row with fewer words has one, of all its words) and their bounds."""
    n = np.diff(per_row)
    if not len(hashes):
        return np.zeros(0, U), np.zeros(len(per_row), np.int64)
    full = len(hashes) - k + 1
    if full > 0:
        whole = np.full(full, U(k))
        for j in range(k):
            whole = mixed(whole + hashes[j : j + full])
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(per_row[:-1] - bounds[:-1], count)
    at = np.arange(bounds[-1]) + first
    out = np.empty(len(at), U)
    fits = np.repeat(n >= k, count)
    if full > 0:
        out[fits] = whole[at[fits]]
    for row in np.flatnonzero((n > 0) & (n < k)):
        h = np.array([n[row]], U)
        for j in range(per_row[row], per_row[row + 1]):
            h = mixed(h + hashes[j])
        out[bounds[row]] = h[0]
    return out, bounds

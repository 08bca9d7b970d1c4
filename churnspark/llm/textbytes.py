"""Words and hashes of Arrow text columns, computed on the UTF-8 bytes with numpy.

A word is a run of bytes other than space and 0x09-0x0D. These bytes never occur inside a
longer UTF-8 sequence, so words of bytes are words of characters. All functions take whole
columns and work on slices of about ``SLICE_BYTES`` of text (at least one whole text), so
that memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_BYTES = np.arange(256)
IS_BLANK = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection, so distinct values stay distinct)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    v *= np.uint64(0xD6E8FEB86659FD93)
    v ^= v >> np.uint64(32)
    return v


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    size = len(column)
    if size == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + size + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    if column.null_count:
        # A null's slot may hold bytes: keep only those of the others.
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.where(valid, np.diff(offsets), 0)
        pieces = [data[a:b] for a, b, ok in zip(offsets[:-1], offsets[1:], valid) if ok and b > a]
        data = np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)
        return data, np.concatenate([[0], np.cumsum(lengths)])
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold at most ``limit`` bytes together, or one longer text."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def texts(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) per slice of a column."""
    data, offsets = utf8(column)
    for first, last in slices(offsets, limit):
        a, b = offsets[first], offsets[last]
        yield first, last, data[a:b], offsets[first : last + 1] - a


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; a word ends with its text."""
    inside = ~IS_BLANK[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(count: int, held: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of the base and of its inverse modulo 2^64, kept for the next call."""
    if held.get("count", 0) < count:
        size = max(count, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            held[name] = np.multiply.accumulate(values)
        held["count"] = size
    return held["up"], held["down"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per span of bytes; spans are in order, not empty and do not overlap.

    The hash is a polynomial of the span's byte codes: the difference of two running sums over
    a stretch of bytes, divided by the power at which the span starts, and mixed.
    """
    found = np.zeros(len(start), np.uint64)
    first = 0
    while first < len(start):
        origin = start[first]
        last = int(np.searchsorted(end, origin + SLICE_BYTES, side="right"))
        last = max(last, first + 1)
        stretch = data[origin : end[last - 1]]
        up, down = _powers(len(stretch) + 1)
        sums = np.zeros(len(stretch) + 1, np.uint64)
        np.cumsum(_CODES[stretch] * up[: len(stretch)], out=sums[1:])
        low, high = start[first:last] - origin, end[first:last] - origin
        found[first:last] = (sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64) * _BASE
        first = last
    return mix(found)


def window_hashes(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every window of ``width`` words inside one text.

    A text with fewer words, but at least one, gives one window with all of them. The rows
    of the words must be in order.
    """
    if len(hashes) == 0:
        return hashes, rows
    factors = [mix(np.array([i + 1], np.uint64) * _BASE)[0] | np.uint64(1) for i in range(width)]
    full = len(hashes) - width + 1
    values, owner = np.zeros(0, np.uint64), np.zeros(0, rows.dtype)
    if full > 0:
        sums = np.zeros(full, np.uint64)
        for i, factor in enumerate(factors):
            sums += mix(hashes[i : i + full] + factor) * factor
        same = rows[:full] == rows[width - 1 :]
        values, owner = mix(sums)[same], rows[:full][same]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(rows)]]))
    short = counts < width
    if short.any():
        extra = []
        for at, size in zip(starts[short], counts[short]):
            total = np.array([size], np.uint64)
            for i in range(size):
                total = mix(hashes[at + i : at + i + 1] + factors[i]) ^ (total * factors[i])
            extra.append(mix(total))
        values = np.concatenate([values, *extra])
        owner = np.concatenate([owner, rows[starts[short]]])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    return values, owner


def distinct_per_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row, ascending within the row."""
    if len(values) == 0:
        return values, rows
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[first], rows[first]

"""Vectorised text primitives shared by the document operators.

Everything works on the UTF-8 bytes of an Arrow string column, a bounded slice
of whole texts at a time, so that memory follows the slice and not the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once. One longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)

#: Separators of words: the space and U+0009 to U+000D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, _BASE, np.uint64))))
            self.down = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, _INV, np.uint64))))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each run; equal runs hash equally wherever they stand."""
    up, down = _POWERS.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive rows whose texts together hold about `limit` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        row = 0
        while row < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            last = min(max(last, row + 1), batch.num_rows)
            yield batch.slice(row, last - row), data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
            row = last


class Words:
    """The words of a slice of texts.

    starts, ends: byte positions of each word; first: index of each text's first
    word (one more entry than texts); hashes: 64-bit hash of each word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.data = data = LOWER[data] if lower else data
        self.offsets, n = offsets, len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~SEPARATOR[data]
        border = np.zeros(n + 1, bool)
        border[offsets] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = run_hashes(_BYTE[data], self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of n words inside one text, the index of each run's first word, and its text."""
        counts = self.counts()
        per_text = np.maximum(counts - n + 1, 0)
        text = np.repeat(np.arange(len(counts)), per_text)
        at = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text) + np.repeat(self.first[:-1], per_text)
        return run_hashes(self.hashes, at, at + n), at, text


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)

"""Helpers for operators that read texts as Arrow batches in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 1 << 20


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` text bytes, one row at least.

    Bounds the memory of vectorised work by the limit or one text, whichever is
    larger, however many rows an Arrow batch holds.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        off = text_bytes(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def row_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values[off[i]:off[i + 1]]`` for every row, empty rows 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


# ---------------------------------------------------------------- words
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240817)).integers(
    0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + (1 << 16)), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 2 * BLOCK_BYTES:  # a single longer text keeps nothing behind
            _POWERS[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs give unrelated outputs."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def spans(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses a row."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[off] = True
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space."""
    return spans(~_SPACE[raw], off)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``raw[starts[i]:ends[i]]``."""
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_POWER, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_INVERSE, n + 1)[starts]
               + (ends - starts).astype(np.uint64))

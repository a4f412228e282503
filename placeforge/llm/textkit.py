"""Vectorised byte and word work over Arrow batches.

Texts are handled as UTF-8 bytes. A batch is walked in chunks of bounded size,
so memory follows the chunk (or the longest single text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(16, int(n - 1).bit_length()))[:n]


def text_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) in chunks of about `limit` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word (with a last bound)."""
    inside = ~space[raw]
    fresh = np.ones(len(raw), bool)
    if len(raw):
        fresh[1:] = ~inside[:-1]
        fresh[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(inside & fresh)
    last = np.ones(len(raw), bool)
    if len(raw):
        last[:-1] = ~inside[1:] | fresh[1:]
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of raw[start:end], equal for equal bytes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))


def per_text(values: np.ndarray, first: np.ndarray, reduce, empty) -> np.ndarray:
    """reduce.reduceat over each text's slice of `values`; `empty` where a text has none."""
    out = np.full(len(first) - 1, empty, values.dtype)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = reduce.reduceat(values[: first[-1]], first[full])
    return out


def runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Whole runs of equal keys from batches that are sorted by it; a run is at most one unit."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut_at = len(keys) - 1
        while cut_at > 0 and keys[cut_at - 1] == keys[-1]:
            cut_at -= 1
        if cut_at == 0 and held and held[-1].column(key)[-1].as_py() == keys[0]:
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut_at)])
        held = [batch.slice(cut_at)]
    if held:
        yield pa.Table.from_batches(held)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

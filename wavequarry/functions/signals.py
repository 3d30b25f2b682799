"""Numpy views of nested signal columns inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def channel_groups(x: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, channel, samples) for each channel length in a batch; null readings become NaN."""
    if isinstance(x, pa.ChunkedArray):
        x = x.combine_chunks()
    per_row = np.nan_to_num(x.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    flat = x.flatten()
    row = np.repeat(np.arange(len(x)), per_row)
    first = np.cumsum(per_row) - per_row
    ch = np.arange(len(row)) - np.repeat(first, per_row)
    length = np.nan_to_num(flat.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(length) - length
    for n in np.unique(length):
        if n > 0:
            at = np.flatnonzero(length == n)
            if len(at) * n == len(values):
                yield row[at], ch[at], values.reshape(len(at), n)
            else:
                yield row[at], ch[at], values[start[at, None] + np.arange(n)]


def matrix(values: pa.ListScalar) -> np.ndarray:
    """One nested list of equally long channels as a float64 matrix."""
    rows = values.values
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(rows), -1) if len(rows) else flat.reshape(0, 0)


def nested(matrices: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Matrices as a nested list column."""
    flat = np.concatenate([m.reshape(-1) for m in matrices]) if matrices else np.zeros(0)
    widths = np.concatenate([np.full(len(m), m.shape[1]) for m in matrices]) if matrices else np.zeros(0, dtype=np.int64)
    inner = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    outer = np.concatenate([[0], np.cumsum([len(m) for m in matrices])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(outer), pa.ListArray.from_arrays(pa.array(inner), pa.array(flat).cast(kind)))

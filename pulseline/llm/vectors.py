"""Vector columns as integer matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def integers(column, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the vectors that take part, their components as
    floor(scale * x), their lengths) of an Arrow list column.  Null vectors and those with a
    null or non-finite component take no part; rows are padded with zeros to
    the longest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), length)
    there[row[~np.isfinite(flat)]] = False
    start = np.cumsum(length) - length
    width = int(length[there].max(initial=0))
    out = np.zeros((len(column), width))
    good = there[row]
    out[row[good], (np.arange(len(flat)) - start[row])[good]] = flat[good]
    places = np.flatnonzero(there)
    out = np.floor(out[places] * scale)
    if np.abs(out).max(initial=0) >= 2 ** 31:
        raise ArithmeticError(f"a vector component times {scale} is beyond 31 bits")
    return places, out.astype(np.int64), length[places]


def id_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow column of ids as int64 (null: 0) and where it is null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.int64())
    return (column.fill_null(0).to_numpy(zero_copy_only=False),
            column.is_null().to_numpy(zero_copy_only=False))


def to_ids(ids: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=null)

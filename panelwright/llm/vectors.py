"""Vectors as whole numbers, in tasks: which rows take part, and their components scaled and rounded down."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Products and squared distances are computed in 64-bit floating point, which is exact for whole numbers up to this.
EXACT = 1 << 53


def whole(column: pa.Array, scale: int, below: int = EXACT // 16) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of finite components, and ``floor(scale * x)`` of these, a row each.

    A null vector, and one with a null or non-finite component, takes no part. Vectors of several lengths fail, and so do
    components whose squares, summed over a vector, could reach ``below``.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets)).astype(np.int64)
    present = column.is_valid().to_numpy(zero_copy_only=False)
    sizes[~present] = 0  # what null rows may hold in the buffers counts for nothing
    flat = column.flatten()
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    values[~flat.is_valid().to_numpy(zero_copy_only=False)] = np.nan
    bad = ~np.isfinite(values)
    row = np.repeat(np.arange(len(column)), sizes)
    kept = present & (np.bincount(row, bad, len(column)) == 0)
    lengths = np.unique(sizes[kept])
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {lengths[:5].tolist()}")
    width = int(lengths[0]) if len(lengths) else 0
    numbers = np.floor(scale * values[kept[row]]).reshape(-1, width) if width else np.zeros((int(kept.sum()), 0))
    check(numbers, width, below)
    return kept, numbers.astype(np.int64)


def check(numbers: np.ndarray, width: int, below: int = EXACT // 16) -> None:
    """Fail if sums of ``width`` squares could reach ``below``; as it is, sums of products of differences stay exact."""
    if numbers.size and width * float(np.abs(numbers).max()) ** 2 >= below:
        raise ValueError(f"components beyond {int((below / max(width, 1)) ** 0.5)} after scaling cannot be computed exactly")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers as 64-bit whole numbers, exact if they are below 2**62.

    Where 64-bit floating point may round, numbers are halved into high and low 16 bits and the four products added up.
    """
    a, b = a.astype(np.float64), b.astype(np.float64)
    longest = [float(np.sqrt((x * x).sum(axis=1)).max(initial=0.0)) for x in (a, b)]
    if longest[0] * longest[1] < EXACT / 2:
        return (a @ b.T).astype(np.int64)
    half = float(1 << 16)
    (a1, a0), (b1, b0) = ((np.floor(x / half), x - half * np.floor(x / half)) for x in (a, b))
    high, middle, low = ((x).astype(np.int64) for x in (a1 @ b1.T, a1 @ b0.T + a0 @ b1.T, a0 @ b0.T))
    return (high << 32) + (middle << 16) + low


def rounded_root(square: int) -> int:
    """The square root, rounded up."""
    from math import isqrt

    root = isqrt(square)
    return root + (root * root < square)

"""Vectors from Arrow list columns, and the grid of blocks that meets every block with every other once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Each row in double precision; None for null or empty rows and those with null or non-finite components."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    offsets = column.offsets.to_numpy()
    finite = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok and b > a and finite[a] == finite[b] else None for ok, a, b in zip(valid, offsets, offsets[1:], strict=False)]


def grid(block: Column, blocks: int) -> Column:
    """The cells (i, j), i <= j, that a row of this block goes to, with the side it takes there (0: i, 1: j)."""
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    return F.transform(others, lambda k: F.struct(F.least(block, k).alias("i"), F.greatest(block, k).alias("j"), (block > k).cast("int").alias("side")))

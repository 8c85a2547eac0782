"""Vector columns as numpy arrays, and integer vectors in expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entries beyond this are held at it, so that sums with small offsets stay within 64 bits.
LARGEST = 2.0**62


def finite(column: Column) -> Column:
    """TRUE for a vector without null and non-finite entries."""
    return F.coalesce(F.forall(column, lambda c: F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False))


def scaled(column: Column, factor: int, offset: int = 0) -> Column:
    """floor(factor * entry) + offset per entry, as longs."""

    def one(c: Column) -> Column:
        x = F.least(F.greatest(F.lit(float(factor)) * c.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
        return F.floor(x) + F.lit(offset).cast("long")

    return F.transform(column, one)


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length in a column of vectors: the rows that have it, and their entries as a matrix."""
    ends = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values)
    lengths = np.diff(ends)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[ends[rows][:, None] + np.arange(length)]

"""Vectors of a batch as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector has an entry and only finite, non-null ones."""
    v = vector.cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & (F.size(v) > 0), F.lit(False))


def matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Rows of ``size`` entries each, in double precision."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, size)

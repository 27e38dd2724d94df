"""Sums of arrays over all rows of a frame, in one pass.

Each task adds up what its rows give; a second stage of ``ROOTS`` tasks adds the
tasks' arrays, so the driver receives ``ROOTS`` arrays whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROOTS = 8
_SCHEMA = "part binary"


def _batch(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column(0):
            own = np.frombuffer(part.as_buffer(), np.float64)
            total = own if total is None else total + own
    if total is not None:
        yield _batch(total)


def summed(df: DataFrame, task: Callable[[Iterable[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray | None:
    """The sum of the float64 arrays, flat, that ``task`` gives for the batches of
    each task; None from a task that has nothing to add, and if none has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = task(batches)
        if own is not None:
            yield _batch(np.ascontiguousarray(own, np.float64).ravel())

    parts = df.mapInArrow(run, _SCHEMA).repartition(ROOTS).mapInArrow(_add, _SCHEMA).toArrow()
    arrays = sorted(p.as_py() for p in parts["part"])
    return sum(np.frombuffer(p, np.float64) for p in arrays) if arrays else None

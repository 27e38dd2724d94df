"""Distinct counts that merge over months: one sketch a group and month."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions._col import as_col

#: Registers of a sketch, as a power of two (4 KiB at most).
LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error of a merged count, that many standard deviations wide."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def monthly_sketches(df: DataFrame, keys: Sequence[str], month: str, value, lg_k: int = LG_K) -> DataFrame:
    """(keys, month, sketch) of the distinct non-null values. A sketch's size does not
    grow with its group, and partial ones are combined before the shuffle."""
    own = df.select(*keys, month, as_col(value).cast("string").alias("__v"))
    return own.groupBy(*keys, month).agg(F.hll_sketch_agg("__v", lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """(keys, n): about ``COUNT(DISTINCT value)`` over all months given, from their
    sketches alone; within :func:`error_bound` of the exact count."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))

"""Ranking and latest-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_desc(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
              out: str = "r") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_cols DESC)``; NULLs last.

    Add a unique tie-break column to ``order_cols`` when ties must be stable.
    A filter ``r <= k`` on the result lets Spark cut each partition to k rows
    before the shuffle (WindowGroupLimit), which also tames a hot key.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_cols])
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def rank_desc_split(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], out: str = "r",
                    partitions: int | None = None, stage=None) -> DataFrame:
    """``rank_desc`` for keys that may hold a large share of all rows.

    ``order_cols`` must make the order unique within a key (add an id).
    Steps, all distributed:

    1. range-partition by (keys, order DESC): a hot key spreads over many
       partitions, each holding a contiguous slice of its order;
    2. write that layout with its partition id (``stage``), so a recomputed
       stage cannot re-sample different range bounds;
    3. number rows inside each (partition, key) slice;
    4. offset of a slice = rows of the same key in earlier partitions, from a
       count table with at most ``partitions`` rows per key;
    5. rank = offset + local number.
    """
    from claimweave.sources.sinks import stage as stage_table

    stage = stage or stage_table
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).desc_nulls_last() for c in order_cols]
    laid = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(
        "__pid", F.spark_partition_id())
    laid = stage(laid, "rank_layout")
    w_local = Window.partitionBy("__pid", *keys).orderBy(*order)
    local = laid.withColumn("__lrn", F.row_number().over(w_local))
    counts = laid.groupBy(*keys, "__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    w_prev = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.struct(*keys).alias("__slice"), F.col("__pid").alias("__slice_pid"),
        F.coalesce(F.sum("__cnt").over(w_prev), F.lit(0)).alias("__off"))
    # A NULL key is a partition of its own, as in a window.
    same = [F.col(k).eqNullSafe(F.col("__slice")[k]) for k in keys]
    j = local.join(offsets, reduce(and_, same, F.col("__pid") == F.col("__slice_pid")))
    ranked = j.withColumn(out, (F.col("__off") + F.col("__lrn")).cast("bigint"))
    return ranked.drop("__pid", "__lrn", "__off", "__slice", "__slice_pid")


def latest_value_per_key(df: DataFrame, keys: Sequence[str], value: str,
                         out: str | None = None) -> DataFrame:
    """``row_number() ... DESC = 1`` then ``DISTINCT key, value`` is the key's MAX.

    Written as an aggregate: partial max map-side, so skew costs nothing.
    """
    return df.groupBy(*keys).agg(F.max(value).alias(out or value))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Whole latest row per key (greatest ``order_cols``, NULLs lose), as an aggregate.

    ``max_by`` over a struct ordering is combined map-side like any max.
    Include a unique column in ``order_cols`` to make ties deterministic.
    """
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order_cols)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")

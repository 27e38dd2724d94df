"""Ordered lists of hot groups in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions._col import as_col
from claimweave.sources.sinks import stage


def list_chunks(df: DataFrame, keys: Sequence[str], value, sep: str = ",", most: int = 10_000, out: str = "list",
                partitions: int | None = None) -> DataFrame:
    """(keys, chunk, list): ``ordered_list`` cut into pieces of ``most`` values.

    Joined by ``sep`` in the order of ``chunk`` (0, 1, ...), a group's pieces are its
    whole list; no row holds more than ``most`` values, however large the group, and
    none is gathered in one task: values are counted, range-partitioned by (group,
    value) and given their place by sums within slices and over the slices before.
    NULL values are skipped; a group with only NULLs has one piece, NULL.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*keys, as_col(value).cast("string").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    laid = counted.repartitionByRange(n, *keys, "__v").withColumn("__pid", F.spark_partition_id())
    laid = stage(laid, "list_layout")
    some = laid.where(F.col("__v").isNotNull())
    before = Window.partitionBy("__pid", *keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    local = some.withColumn("__at", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    # At most ``partitions`` rows a group.
    slices = some.groupBy(*keys, "__pid").agg(F.sum("__n").alias("__slice_n"))
    earlier = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.struct(*keys).alias("__slice"), F.col("__pid").alias("__slice_pid"),
                           F.coalesce(F.sum("__slice_n").over(earlier), F.lit(0)).alias("__off"))
    same = [F.col(k).eqNullSafe(F.col("__slice")[k]) for k in keys]
    placed = local.join(slices, reduce(and_, same, F.col("__pid") == F.col("__slice_pid"))).withColumn(
        "__from", F.col("__off") + F.col("__at"))
    last = F.col("__from") + F.col("__n") - 1
    split = placed.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("__from") / most), F.floor(last / most))))
    begin = F.greatest("__from", F.col("chunk") * most)
    copies = F.least(last + 1, (F.col("chunk") + 1) * most) - begin
    piece = F.sort_array(F.collect_list(F.struct(begin.alias("at"), F.col("__v").alias("v"), copies.cast("int").alias("n"))))
    joined = F.array_join(F.flatten(F.transform(piece, lambda p: F.array_repeat(p["v"], p["n"]))), sep)
    lists = split.groupBy(*keys, "chunk").agg(joined.alias(out))
    only_null = laid.groupBy(*keys).agg(F.count("__v").alias("__some")).where("__some = 0")
    return lists.unionByName(only_null.select(*keys, F.lit(0).cast("long").alias("chunk"), F.lit(None).cast("string").alias(out)))

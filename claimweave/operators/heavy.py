"""Joins in which one key may hold a large share of the rows.

A frequent-items sketch of the keys (one aggregation, a few kilobytes whatever the
table) names every key that holds more than a partition's share. Rows of those
keys are dealt over as many salts as they fill pieces, and the other side's rows of
those keys are repeated for each salt; all other keys join as they are. This does not
depend on AQE, which splits only what a finished shuffle shows to be skewed and
whose rules exclude some joins.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimweave.functions._col import as_col

#: Keys that the sketch follows; one with more than 1/TRACKED of the rows is never missed.
TRACKED = 4096
#: A heavy key's pieces are this share of a partition's mean rows.
PIECE = 1 / 8
_SALT = "__salt"


def heavy_keys(df: DataFrame, key, partitions: int, tracked: int = TRACKED) -> dict:
    """{key: salts} of the keys whose rows fill more than one piece of a partition.

    The number of heavy keys is bounded by the pieces of all partitions, and by
    ``tracked``.
    """
    own = df.select(as_col(key).alias("k")).where(F.col("k").isNotNull())
    most = min(tracked, max(1, math.ceil(partitions / PIECE)))
    row = own.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {max(tracked, most)})").alias("top")).first()
    piece = max(1.0, row["n"] / partitions * PIECE)
    return {r["item"]: math.ceil(r["count"] / piece) for r in row["top"] or [] if r["count"] > 2 * piece}


def salted_join(left: DataFrame, right: DataFrame, left_key, right_key, how: str = "left",
                salts: dict | None = None, partitions: int | None = None) -> DataFrame:
    """``left.join(right, left_key == right_key, how)`` (inner or left), with the heavy
    keys of ``left`` salted; ``salts`` may come from an earlier :func:`heavy_keys`.

    A row of ``left`` takes its salt from a hash of its columns, so a lost task gives
    the same rows again (and equal rows one salt); its partners in ``right`` are
    repeated for every salt, so each pair is met once. Both sides' columns have to
    differ by name.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner and left joins only")
    spark = left.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = heavy_keys(left, left_key, n) if salts is None else salts
    on = as_col(left_key) == as_col(right_key)
    if not salts:
        return left.join(right, on, how)
    kind = left.select(as_col(left_key).alias("k")).schema["k"].dataType
    heavy = spark.createDataFrame(list(salts.items()), StructType([StructField("__hot", kind), StructField("__n", LongType())]))
    # At most TRACKED rows.
    mark = lambda df, key: df.join(F.broadcast(heavy), as_col(key) == F.col("__hot"), "left")
    own = [c for c, kind in left.dtypes if "map<" not in kind and "variant" not in kind]
    salt = F.coalesce(F.pmod(F.xxhash64(*own), F.col("__n")), F.lit(0))
    salted = mark(left, left_key).withColumn(f"{_SALT}_l", salt).drop("__hot", "__n")
    last = F.coalesce(F.col("__n"), F.lit(1)) - 1
    every = mark(right, right_key).withColumn(f"{_SALT}_r", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("__hot", "__n")
    return salted.join(every, on & (F.col(f"{_SALT}_l") == F.col(f"{_SALT}_r")), how).drop(f"{_SALT}_l", f"{_SALT}_r")

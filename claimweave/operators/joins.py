"""Joins with the reference's NULL rules, written so they scale.

No operator here hints a broadcast: join strategy is left to Catalyst and
AQE, which only broadcast a side after measuring it against
``spark.sql.adaptive.autoBroadcastJoinThreshold``. Key sets are de-duplicated
before they are shuffled (map-side partial aggregation), so a key that holds
a third of all rows arrives at the join as one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions._col import as_col
from claimweave.sources.sinks import stage

_K = "__key"


def _key_set(keys_df: DataFrame, keys_col) -> DataFrame:
    return keys_df.select(as_col(keys_col).alias(_K))


def semi_in(df: DataFrame, key, keys_df: DataFrame, keys_col=None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys_df`` (``key IN (SELECT ...)``).

    ``key`` may be a computed Column. NULL keys never match (a NULL part of a
    composite key drops the row, as in the reference).
    """
    keys_col = keys_col if keys_col is not None else key
    ks = _key_set(keys_df, keys_col).where(F.col(_K).isNotNull()).distinct()
    return df.join(ks, as_col(key) == F.col(_K), "left_semi")


def not_in(df: DataFrame, key, keys_df: DataFrame, keys_col=None, written: bool = True) -> DataFrame:
    """``key NOT IN (SELECT keys_col FROM keys_df)`` with full three-valued logic.

    * empty key set      -> every row passes (even a NULL key);
    * a NULL in the set  -> no row passes;
    * otherwise          -> non-NULL keys absent from the set pass.

    Spark plans SQL ``NOT IN`` as a null-aware anti join that must broadcast
    the whole key set. Here one scalar subquery classifies the set, and the
    anti join itself is an ordinary ``left_anti`` that may sort-merge.

    The de-duplicated keys are written once for both; with ``written=False`` they are
    planned twice instead, which is cheaper where they come from a plain scan.
    """
    keys_col = keys_col if keys_col is not None else key
    # One de-duplicated key set (NULL kept as one row) feeds both the state and
    # the anti join.
    ks = _key_set(keys_df, keys_col).distinct()
    ks = stage(ks, "not_in_keys") if written else ks
    state = ks.select(
        F.when(F.count(F.lit(1)) == 0, F.lit(2))
        .when(F.count_if(F.col(_K).isNull()) == 0, F.lit(1))
        .otherwise(F.lit(0))
    ).scalar()
    k = as_col(key)
    kept = df.where((state == 2) | ((state == 1) & k.isNotNull()))
    present = ks.where(F.col(_K).isNotNull())
    return kept.join(present, k == F.col(_K), "left_anti")


def classify_by_priority(classes: Sequence[tuple[str, DataFrame]], key: str,
                         label_col: str = "tipo") -> DataFrame:
    """Union of candidate classes, each minus the keys claimed by earlier classes.

    ``classes`` is ordered by priority. Class *i* keeps its rows whose ``key``
    is NOT IN the keys *output* by classes ``0..i-1`` (NULL rules of
    :func:`not_in`). All candidates are read once, in one union that is written,
    and each key's least class follows from one map-side combined aggregate of
    it, joined back on the key. What NULL keys do is settled by the first classes alone:

    * while no earlier class has a row, the claimed set is empty and NULL keys pass;
    * a NULL key that has passed empties every later class.
    """
    columns = classes[0][1].columns
    tagged = [d.select(*columns, F.lit(i).alias("__idx")) for i, (_, d) in enumerate(classes)]
    every = stage(reduce(DataFrame.unionByName, tagged), "candidates")
    first = every.groupBy(F.col(key).alias("__claimed")).agg(F.min("__idx").alias("__least"))
    # The first class with any row passes whole; a NULL key in it ends the chain.
    opening = first.agg(F.min("__least").alias("open"),
                        F.min(F.when(F.col("__claimed").isNull(), F.col("__least"))).alias("null"))
    start = opening.select("open").scalar()
    closed = opening.select(F.coalesce(F.col("null") == F.col("open"), F.lit(False))).scalar()
    claimed = first.where(F.col("__claimed").isNotNull())
    keyed = every.where(F.col(key).isNotNull()).join(
        claimed, (F.col(key) == F.col("__claimed")) & (F.col("__idx") == F.col("__least")), "left_semi")
    rows = keyed.unionByName(every.where(F.col(key).isNull() & (F.col("__idx") == start)))
    label = F.element_at(F.array(*[F.lit(name) for name, _ in classes]), F.col("__idx") + 1)
    return rows.where((F.col("__idx") == start) | ~closed).withColumn(label_col, label).drop("__idx")


def lookup_code(df: DataFrame, dim: DataFrame, name, dim_name: str, dim_code: str,
                out: str, default) -> DataFrame:
    """Left join a dimension **by name** and take its code, ``default`` if absent.

    A name with two codes duplicates the row, exactly like the reference.
    """
    d = dim.select(F.col(dim_name).alias("__dim_name"), F.col(dim_code).alias("__dim_code"))
    j = df.join(d, as_col(name) == F.col("__dim_name"), "left")
    return (j.withColumn(out, F.coalesce(F.col("__dim_code"), F.lit(default)))
             .drop("__dim_name", "__dim_code"))


def flag_from_keys(df: DataFrame, keys_df: DataFrame, key: str, keys_col: str,
                   flag_col: str, value: str) -> DataFrame:
    """``LEFT JOIN (SELECT DISTINCT k, 'E' flag ...)``: ``value`` if the key is in the set, else NULL."""
    ks = (keys_df.select(F.col(keys_col).alias("__fk")).where(F.col("__fk").isNotNull())
          .distinct().withColumn(flag_col, F.lit(value)))
    return df.join(ks, F.col(key) == F.col("__fk"), "left").drop("__fk")


def join_hit(left_key, right_key, matched, otherwise) -> Column:
    """``CASE WHEN a.k = b.k THEN matched ELSE otherwise END`` after a left join."""
    return F.when(as_col(left_key) == as_col(right_key), as_col(matched)).otherwise(as_col(otherwise))

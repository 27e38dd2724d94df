"""First dates and repeats kept as monthly states, so history is not read again.

A state row says of a group (say a member and a diagnosis) when it was first seen,
and the least and the greatest of its events: they differ exactly if the group has
two different events. Minima and maxima merge in any order, so the states of the
months give what the whole history gives, and a month that is run again replaces
its own state only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions._col import as_col
from claimweave.sources.months import MONTH_COL, replace_months


def event_state(df: DataFrame, keys: Sequence[str], date, event, by: Sequence[str] = ()) -> DataFrame:
    """(keys, by, first_date, least_event, greatest_event) of the rows of ``df``."""
    own = as_col(event)
    return df.groupBy(*keys, *by).agg(F.min(as_col(date)).alias("first_date"), F.min(own).alias("least_event"),
                                      F.max(own).alias("greatest_event"))


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state of each group, from several."""
    return states.groupBy(*keys).agg(F.min("first_date").alias("first_date"), F.min("least_event").alias("least_event"),
                                     F.max("greatest_event").alias("greatest_event"))


def repeated(state: DataFrame) -> DataFrame:
    """The groups with two different events or more (``COUNT(DISTINCT event) >= 2``)."""
    return state.where(F.col("least_event") < F.col("greatest_event"))


def write_months(df: DataFrame, path: str, which, keys: Sequence[str], date, event, month: str = MONTH_COL) -> None:
    """Write the states of the months ``which`` of ``df``, in place of those there."""
    replace_months(event_state(df, keys, date, event, [month]), path, which, month)


def read_states(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The merged state of all months written."""
    return merge_states(spark.read.parquet(path), keys)

"""Monthly-snapshot scans.

Snapshot tables carry a DATE ``periodo``; written partitioned by it, an
equality with a literal becomes a ``PartitionFilters`` entry and only one month
is read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _date_lit(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)))


def snapshot(df: DataFrame, month, col: str = "periodo") -> DataFrame:
    """Rows of one snapshot month (``WHERE periodo = <date>``)."""
    return df.where(F.col(col) == _date_lit(month))


def current_month(as_of=None) -> Column:
    """``DATE_TRUNC(as_of, MONTH)``; ``as_of`` defaults to ``current_date()``.

    Both forms fold to a literal before planning, so partition pruning holds.
    """
    base = F.current_date() if as_of is None else _date_lit(as_of)
    return F.trunc(base, "MM")


def latest_snapshot(df: DataFrame, bound, col: str = "periodo") -> Column:
    """Scalar subquery ``(SELECT MAX(col) FROM df WHERE col <= bound)``.

    Returned as a Column: it runs as a one-row subquery next to the main
    plan - no collect to the driver, no cross join.
    """
    return df.where(F.col(col) <= _date_lit(bound)).select(F.max(col)).scalar()

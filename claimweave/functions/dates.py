"""Dates, zoneless datetimes and the reference's date idioms."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions._col import as_col


def ts_ntz(value) -> Column:
    """A zoneless timestamp literal (folds to a constant; pushes to parquet)."""
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def in_year(ts, *years: int) -> Column:
    """``year(ts) IN years`` written as half-open ranges so both bounds reach the scan."""
    ts = as_col(ts)
    cond = None
    for y in years:
        r = (ts >= ts_ntz(f"{y}-01-01")) & (ts < ts_ntz(f"{y + 1}-01-01"))
        cond = r if cond is None else (cond | r)
    if cond is None:
        raise ValueError("in_year needs at least one year")
    return cond


def month_start(d) -> Column:
    """First day of the month as a DATE (``DATE_TRUNC(d, MONTH)``)."""
    return F.trunc(as_col(d), "MM")


def strict_date(s, fmt: str = "yyyyMMdd") -> Column:
    """Parse or fail the query (``PARSE_DATE``)."""
    return F.to_date(as_col(s), fmt)


def safe_date(s, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse or NULL (``SAFE.PARSE_DATE``)."""
    return F.try_to_date(as_col(s), fmt)


def month_end_fallback(s) -> Column:
    """``yyyy-MM-dd`` text -> zoneless datetime at midnight.

    A valid date is kept; an impossible day (e.g. 2024-02-30) becomes the last
    day of that month; an impossible month gives NULL. The result type is a
    datetime because the reference subtracts an interval from a date.
    """
    s = as_col(s)
    exact = safe_date(s, "yyyy-MM-dd")
    first = safe_date(F.concat(F.substr(s, F.lit(1), F.lit(7)), F.lit("-01")), "yyyy-MM-dd")
    return F.coalesce(exact, F.last_day(first)).cast("timestamp_ntz")


def days_between(end, start) -> Column:
    """Calendar-day boundaries crossed between two datetimes (``DATE_DIFF(.., DAY)``)."""
    return F.datediff(as_col(end), as_col(start))


def add_stay(d, days) -> Column:
    """``d + days`` when a stay length exists, else ``d``."""
    d, days = as_col(d), as_col(days)
    return F.when(days.isNotNull(), F.date_add(d, days.cast("int"))).otherwise(d)


def fmt_yyyymm(d) -> Column:
    return F.date_format(as_col(d), "yyyyMM")


def fmt_datetime(d) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text of a date or datetime."""
    return F.date_format(as_col(d).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")


def earlier_of(c, m) -> Column:
    """``CASE WHEN c > m THEN m ELSE c END``: a NULL on either side keeps ``c``.

    Not ``least``, which would skip the NULL and pick the other value.
    """
    c, m = as_col(c), as_col(m)
    return F.when(c > m, m).otherwise(c)

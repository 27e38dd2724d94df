"""Text cleaning and recoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions._col import as_col

# (?U) makes \s match every Unicode white-space character, as the warehouse TRIM does.
_EDGE_WS = r"(?U)^\s+|\s+$"


def trim_ws(c) -> Column:
    """Strip all leading and trailing white space (tabs, NBSP, ... not only U+0020)."""
    return F.regexp_replace(as_col(c), _EDGE_WS, "")


def digits_only(c) -> Column:
    return F.regexp_replace(as_col(c), r"[^0-9]", "")


def digits_or_raw(c) -> Column:
    """Digits of ``c``; the raw value when it holds no digit at all."""
    c = as_col(c)
    d = digits_only(c)
    return F.when(d == "", c).otherwise(d)


def remove_char(c, ch: str) -> Column:
    return F.replace(as_col(c), F.lit(ch), F.lit(""))


def first_token(c, sep: str) -> Column:
    """Text before the first ``sep`` (the whole value if absent); NULL stays NULL."""
    return F.substring_index(as_col(c), sep, 1)


def recode(c, mapping: Mapping[str, str], default=None) -> Column:
    """Simple CASE: ``mapping[value]``, else ``default`` (also for NULL)."""
    c = as_col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v)) if out is None
               else out.when(c == F.lit(k), F.lit(v)))
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if out is None else out.otherwise(dflt)


def normalise_place(c, aliases: Sequence[str], canonical: str,
                    unknown: str = "NO DETERMINADO", unknown_codes: Sequence[str] = ("", "ND")) -> Column:
    """Alias -> canonical name; NULL, '' or 'ND' -> ``unknown``; else unchanged."""
    c = as_col(c)
    return (F.when(c.isin(*aliases), F.lit(canonical))
            .when(F.coalesce(c, F.lit("ND")).isin(*unknown_codes), F.lit(unknown))
            .otherwise(c))

"""Composite business keys: build, truncate, prefix, pad.

A NULL in any part makes the whole key NULL (``concat`` semantics), so a row
with an incomplete key never matches a semi join - the same as the reference.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions._col import as_col


def claim_key(*parts, prefix: str = "RS-", sep: str = "-") -> Column:
    """``prefix`` + parts joined by ``sep``; numbers are rendered as strings.

    ``concat`` (not ``concat_ws``) on purpose: a NULL part yields a NULL key.
    """
    pieces: list[Column] = [F.lit(prefix)]
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(as_col(p).cast("string"))
    return F.concat(*pieces)


def truncate_key(c, n: int = 5, sep: str = "-", strict: bool = True) -> Column:
    """First ``n`` ``sep``-separated segments, re-joined.

    With fewer than ``n`` segments the reference's ``[OFFSET(i)]`` fails the
    whole statement; ``strict=True`` raises the same way, ``strict=False``
    returns NULL. NULL input gives NULL.
    """
    c = as_col(c)
    segments = F.size(F.split(c, re.escape(sep), -1))
    short = (F.raise_error(F.concat(F.lit(f"key has fewer than {n} segments: "), c))
             if strict else F.lit(None).cast("string"))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(segments >= n, F.substring_index(c, sep, n))
            .otherwise(short))


def prefixed(c, prefix: str) -> Column:
    """``prefix || c`` (NULL stays NULL)."""
    return F.concat(F.lit(prefix), as_col(c).cast("string"))


def strip_prefix(c, n: int = 3) -> Column:
    """Drop the first ``n`` characters (``SUBSTRING(s, n + 1)``)."""
    return F.substr(as_col(c), F.lit(n + 1))


def pad_lot(c, width: int = 7, fill: str = "0") -> Column:
    """Left-pad the text of ``c`` to ``width``; longer values are cut, like LPAD."""
    return F.lpad(as_col(c).cast("string"), width, fill)

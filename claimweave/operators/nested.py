"""Correlated UNNEST as narrow (shuffle-free) generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, array_col: str, alias: str, outer: bool = True,
                 keep_array: bool = False) -> DataFrame:
    """One row per element of ``array_col``, element exposed as struct ``alias``.

    ``outer=True`` is ``LEFT JOIN UNNEST``: a NULL or empty array keeps one row
    whose element is NULL. Narrow: no exchange, runs inside the scan's stage.
    """
    gen = F.explode_outer(array_col) if outer else F.explode(array_col)
    cols = [c for c in df.columns if keep_array or c != array_col.split(".")[-1]]
    return df.select(*cols, gen.alias(alias))


def explode_path(df: DataFrame, levels: Sequence[tuple[str, str]], outer: bool = True) -> DataFrame:
    """Chained explodes: ``[("atencion_salud", "a"), ("a.procedimiento_salud", "p")]``."""
    for array_col, alias in levels:
        df = explode_rows(df, array_col, alias, outer=outer)
    return df


def keep_elements(array_col, predicate) -> Column:
    """Filter an array before exploding it (only when the outer row is not needed)."""
    col = F.col(array_col) if isinstance(array_col, str) else array_col
    return F.filter(col, predicate)

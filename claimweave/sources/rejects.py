"""Strict parsing that names the rows it can't parse before it fails."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RejectedRows(ValueError):
    """Rows could not be parsed; ``counts`` by column, the rows are at ``path``."""

    def __init__(self, counts: dict[str, int], rows: int, path: str):
        super().__init__(f"{rows} rows rejected ({', '.join(f'{c}: {n}' for c, n in counts.items() if n)}); they are at {path}")
        self.counts, self.rows, self.path = counts, rows, path


def _marked(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reasons``: each column whose text is there but can't be parsed, with the text."""
    why = [F.when(F.col(c).isNotNull() & p.isNull(), F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c, p in parsed.items()]
    return df.withColumn("reasons", F.filter(F.array(*why), lambda r: r.isNotNull()))


def split_rejects(df: DataFrame, parsed: Mapping[str, Column], path: str, strict: bool = True) -> DataFrame:
    """The rows of ``df`` with the columns named in ``parsed`` replaced by its columns.

    Rows in which one of them is NULL though the text is not are written to ``path``
    first, as they came and with ``reasons``. One pass counts and writes them. If there
    are any, the strict form raises :class:`RejectedRows`; the lenient one leaves
    them out.
    """
    marked = _marked(df, parsed)
    bad, seen = F.size("reasons") > 0, Observation("rejects")
    counts = [F.count_if(F.col(c).isNotNull() & p.isNull()).alias(f"n_{k}") for k, (c, p) in enumerate(parsed.items())]
    marked.observe(seen, F.count_if(bad).alias("rows"), *counts).where(bad).write.mode("overwrite").parquet(path)
    got = seen.get
    if strict and got["rows"]:
        raise RejectedRows({c: got[f"n_{k}"] for k, c in enumerate(parsed)}, got["rows"], path)
    return marked.where(~bad).drop("reasons").withColumns(dict(parsed))

"""Held-out folds by a checksum of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.sources.sinks import stage

#: Rows of ``labels`` that a classifier is fitted on, about; more are thinned by a
#: hash of the id. So many (id, label) pairs (16 bytes each) are broadcast.
MOST_LABELLED = 200_000


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id's text leaves ``fold``; a null id is never held out."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % folds == fold, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, text_cols: list[str], train: Column,
             id_col: str = "doc_id", most: int = MOST_LABELLED) -> DataFrame:
    """(label, *text_cols) of the rows of ``docs`` with a label where ``train``
    holds, about ``most`` of them. Several labels of one id count as the largest."""
    own = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).filter(train)
    own = stage(own.groupBy(F.col(id_col).alias("labelled_id")).agg(F.max(label_col).cast("int").alias("label")), "labels")
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64("labelled_id"), F.lit(1_000_000)) < int(1e6 * most / n))
    texts = docs.select(F.col(id_col).alias("own_id"), *text_cols)
    return texts.join(F.broadcast(own), F.col("own_id") == F.col("labelled_id")).select("label", *text_cols)

"""Mixing sources to target weights by capped water-filling.

Sources share ``share`` times all words in proportion to their weights. A
source whose part is above ``most_epochs`` times its own words is clamped there
and the excess is shared again among the others, until none is above. Each
document is then taken the whole number of times that its source's target
holds, and the remaining fraction of an epoch goes to the documents first in a
seeded order, the last of them in part, so a source's taken words equal its
target rounded.

The order within a source is never sorted as a whole: words are summed by
digits of the seeded hash, two steps of three hexadecimal digits find where the
fraction ends, and only documents that share those six digits are ordered.

Defined cases: a null text has size 0; the null source is one source, last in
order; a source without words has target 0; a null id is ordered by the hash of
an empty text; repeated rows that meet the end of a fraction divide it in
proportion to their sizes, rounded down; an empty table gives an empty result.
Other columns are neither read nor touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.ordering import positions
from claimweave.sources.sinks import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST_EPOCHS, SEED = 1.5, 2, 7
DIGITS = 3


def size(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: int = SEED) -> DataFrame:
    """Each row as struct ``row`` with its size, source and place in the seeded order."""
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return docs.select(F.struct("*").alias("row"), size(F.col(text_col)).alias("size"),
                       F.col(source_col).cast("string").alias("source"), place.alias("place"))


def fill(sources: DataFrame, share: float = SHARE, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to (source_size, weight): capped water-filling.

    A round sums what clamped sources hold and the weight of the others; the
    driver sees these sums only.
    """
    cap = F.col("source_size") * F.lit(float(most_epochs))
    level = F.lit(None).cast("double")
    clamped = -1
    while True:
        above = F.coalesce(cap < level * F.col("weight"), F.lit(False))
        total, held, free, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(above, cap).otherwise(0.0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))), F.count(F.when(above, 1))).first()
        if n == clamped or not total or not free:
            break
        clamped, level = n, F.lit((share * total - held) / free)
    part = F.coalesce(level * F.col("weight"), F.lit(0.0))
    return sources.withColumn("target", F.when(part > cap, cap).otherwise(part) if total else F.lit(0.0))


@dataclass
class Mix:
    """How often rows are taken: by source, and for the rows where a fraction ends."""

    sources: DataFrame
    ends: DataFrame

    def apply(self, measured: DataFrame) -> DataFrame:
        """``measured`` with source_size, target and taken; a row's result depends
        on the two small tables alone, so rows are not moved unless these are large."""
        s = self.sources.select(F.col("key").alias("source_key"), "source_size", "target", "whole", "edge")
        e = self.ends.select(F.col("key").alias("end_key"), F.col("place").alias("end_place"), "rest", "size_here")
        rows = measured.join(s, _key() == F.col("source_key"))
        at_edge = F.substring("place", 1, 2 * DIGITS) == F.col("edge")
        rows = rows.join(e, (F.col("source_key") == F.col("end_key")) & (F.col("place") == F.col("end_place")) & at_edge,
                         "left")
        part = (F.when(F.substring("place", 1, 2 * DIGITS) < F.col("edge"), F.col("size"))
                .when(at_edge & (F.col("rest") >= F.col("size_here")), F.col("size"))
                .when(at_edge & (F.col("size_here") > 0), F.expr("rest * size div size_here")).otherwise(0))
        return rows.select("row", "size", "source_size", "target",
                           (F.col("whole") * F.col("size") + F.coalesce(part, F.lit(0))).cast("long").alias("taken"))


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def _edge(rows: DataFrame, quota: DataFrame, at: int) -> DataFrame:
    """(key, left, digits): the digits at which each source's quota ends and what
    of the quota is left before them. Windows hold at most 16 ** DIGITS rows."""
    bins = rows.groupBy("key", F.substring("place", at, DIGITS).alias("digits")).agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("key").orderBy("digits")
    bins = bins.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    return bins.join(quota.select("key", "left"), "key").filter(
        (F.col("before") < F.col("left")) & (F.col("before") + F.col("n") >= F.col("left"))).select(
        "key", "digits", (F.col("left") - F.col("before")).alias("left"))


def plan(measured: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
         most_epochs: float = MOST_EPOCHS) -> Mix:
    """Targets of all sources and where their fractions end; reads size, source
    and place of ``measured`` several times."""
    rows = measured.select(_key().alias("key"), "source", "size", "place")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positions(sources, F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", turn.alias("weight")), "sources")
    filled = fill(ranked, share, most_epochs).select(_key().alias("key"), "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    quota = stage(filled.withColumn("whole", whole).withColumn(
        "left", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")), "quotas")
    first = stage(_edge(rows, quota.filter("left > 0"), 1), "edges")
    inside = rows.join(first.select("key", F.col("digits").alias("d1")), "key").filter(
        F.substring("place", 1, DIGITS) == F.col("d1"))
    second = _edge(inside.select("key", "size", "place"), first, DIGITS + 1)
    edges = stage(second.withColumnRenamed("digits", "d2").join(first.select("key", F.col("digits").alias("d1")), "key")
                  .select("key", "left", F.concat("d1", "d2").alias("edge")), "edges")
    last = rows.join(edges, "key").filter(F.substring("place", 1, 2 * DIGITS) == F.col("edge"))
    last = last.groupBy("key", "place", "left").agg(F.sum("size").alias("size_here"))
    upto = Window.partitionBy("key").orderBy("place")
    last = last.withColumn("rest", F.col("left") - (F.sum("size_here").over(upto) - F.col("size_here")))
    ends = stage(last.filter("rest > 0").select("key", "place", "rest", "size_here"), "edge_rows")
    return Mix(stage(quota.join(edges.select("key", "edge"), "key", "left"), "targets"), ends)

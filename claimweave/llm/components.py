"""Connected components of a link table, by alternating star contraction.

Large-star links each node's larger neighbours to its smallest neighbour,
small-star the smaller ones; a component ends as a star around its smallest
node. Minima are combined before the shuffle and joined back, so a hub's links
are never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.sources.sinks import stage


def _star(links: DataFrame, at: str, other: str) -> tuple[DataFrame, DataFrame]:
    near = links.groupBy(at).agg(F.min(other).alias("low"))
    near = near.select(F.col(at).alias("at"), F.least("low", at).alias("low"))
    return links.join(near, links[at] == near["at"]), near


def _links(df: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    met, _ = _star(both, "a", "b")
    return _links(met.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    met, near = _star(links, "a", "b")
    return _links(met.select(F.col("b").alias("a"), F.col("low").alias("b"))
                  .union(near.select("at", "low")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b: long); the component
    is its smallest node. Nodes without links are not listed."""
    links = stage(_links(links), "links")
    state = _state(links)
    while state[0]:
        links = stage(_small_star(_large_star(links)), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    centers = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centers)

"""Semi join of a large table behind a Bloom filter of the keys.

A semi join of a feed with claim keys shuffles the whole feed, though few of its
rows survive. Here the keys are written once and counted, and a Bloom filter of
them, sized by their number, drops most other rows where the feed is scanned, so
only the survivors are shuffled. The filter is Spark's own runtime filter; it is
planned if the keys count as selective and the feed as large, which the settings
and the key table's predicate here make so. What the filter lets pass by mistake,
the join drops: rows are exactly those of the plain semi join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions._col import as_col
from claimweave.settings import session_conf
from claimweave.sources.sinks import stage

#: A filter of so many bits at most (8 MiB) goes through the driver into the tasks' closures;
#: with more keys it lets more rows pass, and with fewer than LEAST_BITS_EACH bits a key,
#: where nearly half of the others would, the plain semi join runs.
MOST_BITS = 1 << 26
LEAST_BITS_EACH = 2
FALSE_POSITIVES = 0.03
_K = "__key"


def bits_for(keys: int, false_positives: float = FALSE_POSITIVES) -> int:
    """Bits of a Bloom filter of so many keys."""
    return max(64, math.ceil(-max(keys, 1) * math.log(false_positives) / math.log(2) ** 2))


def bloom_settings(keys: int, false_positives: float = FALSE_POSITIVES) -> dict[str, str]:
    """Settings under which a semi join with ``keys`` keys gets its filter; none where
    the filter would be too large. Other joins of the plan get filters of this size as
    well, if a side of theirs is filtered: have the semi join run on its own."""
    bits, own = min(bits_for(keys, false_positives), MOST_BITS), "spark.sql.optimizer.runtime.bloomFilter."
    if keys * LEAST_BITS_EACH > MOST_BITS:
        return {f"{own}enabled": "false"}
    return {f"{own}enabled": "true", f"{own}applicationSideScanSizeThreshold": "0",
            # The key table is small by its count; its files' size is no better guess.
            f"{own}creationSideThreshold": str(1 << 40),
            f"{own}expectedNumItems": str(max(keys, 1)), f"{own}numBits": str(bits),
            f"{own}maxNumItems": str(max(keys, 1)), f"{own}maxNumBits": str(bits)}


def key_table(keys_df: DataFrame, keys_col) -> DataFrame:
    """The distinct non-null keys, written once."""
    own = keys_df.select(as_col(keys_col).alias(_K)).where(F.col(_K).isNotNull()).distinct()
    return stage(own, "filter_keys")


def semi_join_filtered(df: DataFrame, key, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in a :func:`key_table`; run it under
    :func:`bloom_settings`."""
    # Always true, but a comparison: the planner builds filters of such sides only.
    marked = keys.where(F.length(F.col(_K).cast("string")) >= 0)
    return df.join(marked, as_col(key) == F.col(_K), "left_semi")


def semi_in_filtered(df: DataFrame, key, keys_df: DataFrame, keys_col=None, false_positives: float = FALSE_POSITIVES) -> DataFrame:
    """``semi_in`` for a large ``df``: the rows are written, behind the filter."""
    keys = key_table(keys_df, keys_col if keys_col is not None else key)
    with session_conf(df.sparkSession, bloom_settings(keys.count(), false_positives)):
        return stage(semi_join_filtered(df, key, keys), "filtered_rows")

"""Comparing the rows of a bucket without a hot bucket in one task.

Buckets hold index rows, which are compared with each other and with the
bucket's probe rows. A bucket with more than ``block_rows`` index rows is cut
into blocks by a hash of the row; each row of the bucket then goes to every
block that it has to meet, so each comparison is still made, by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.sources.sinks import stage

#: fn(index rows, other rows, whether index rows are compared with each other)
Compare = Callable[[pa.Table, pa.Table, bool], pa.RecordBatch | None]
#: fn(rows, i, j): the pairs of rows to compare
Pairs = Callable[[pa.Table, np.ndarray, np.ndarray], pa.RecordBatch | None]
#: Up to so many hot keys (24 bytes each) are broadcast, more are shuffled.
BROADCAST_KEYS = 10_000
PROBES_AT_ONCE = 4096
#: Buckets of up to so many rows are compared together, as pairs.
SMALL_BUCKET = 64
PAIRS_AT_ONCE = 100_000


def deal(index: DataFrame, probe: DataFrame, block_rows: int) -> DataFrame:
    """Rows of both frames (columns key, id and payload) by bucket and block.

    Column ``role`` is 0 for index rows, 1 for rows compared with them.
    """
    hot = stage(index.groupBy("key").count().filter(F.col("count") > block_rows)
                .select("key", F.ceil(F.col("count") / block_rows).cast("int").alias("blocks")), "hot_buckets")
    many = hot.count()
    cols = index.columns
    if many:
        side = F.broadcast(hot) if many <= BROADCAST_KEYS else hot
        index, probe = index.join(side, "key", "left"), probe.join(side, "key", "left")
        own = F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("id"), "blocks")).otherwise(F.lit(0))
        index = index.withColumn("own", own.cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), "own")))
        index = index.withColumn("role", F.when(F.col("block") == F.col("own"), 0).otherwise(1))
        probe = (probe.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks") - 1, F.lit(0)))))
                 .withColumn("role", F.lit(1)))
        key = F.when(F.col("blocks").isNotNull(), F.xxhash64("key", "block")).otherwise(F.col("key")).alias("key")
        pick = [key, "role", *[c for c in cols if c != "key"]]
        index, probe = index.select(*pick), probe.select(*pick)
    else:
        pick = lambda role: ["key", F.lit(role).alias("role"), *[c for c in cols if c != "key"]]
        index, probe = index.select(*pick(0)), probe.select(*pick(1))
    return index.union(probe).repartition("key").sortWithinPartitions("key", "role")


def _pairs_within(at: np.ndarray, ends: np.ndarray, role: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index rows, rows after them) within the buckets at:ends, some at a time."""
    size = ends - at
    row = np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())
    bucket = np.repeat(np.arange(len(at)), size)
    own = np.bincount(bucket, weights=role[row] == 0, minlength=len(at)).astype(np.int64)
    n = np.minimum(row - at[bucket], own[bucket])
    cut = np.append(np.flatnonzero(np.diff(np.cumsum(n) // PAIRS_AT_ONCE, prepend=0)), len(n))
    lo = 0
    for hi in cut:
        part, k = slice(lo, hi), n[lo:hi]
        if k.sum():
            j = np.repeat(row[part], k)
            yield np.repeat(at[bucket[part]] - np.cumsum(k) + k, k) + np.arange(k.sum()), j
        lo = hi


def compare(dealt: DataFrame, fn: Compare, schema: str, pairs: Pairs | None = None) -> DataFrame:
    """Call ``fn`` for each bucket that has an index row and another row; or
    ``pairs``, if given, for the small buckets of a batch together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, fresh = None, True
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([carry, t]).combine_chunks() if carry is not None else t
            if not t.num_rows:
                continue
            key, role = t["key"].to_numpy(), t["role"].to_numpy()
            at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            ends = np.append(at[1:], len(key))
            done = np.arange(len(at) - 1)
            done = done[((ends - at)[:-1] >= 2) & (role[at[:-1]] == 0)]
            if pairs is not None:
                small = done[(ends - at)[done] <= SMALL_BUCKET]
                small = small if fresh else small[small > 0]
                for i, j in _pairs_within(at[small], ends[small], role):
                    out = pairs(t, i, j)
                    if out is not None:
                        yield out
                done = np.setdiff1d(done, small)
            for g in done:
                out = part(t, role, at[g], ends[g], fresh or g > 0)
                if out is not None:
                    yield out
            fresh = fresh or len(at) > 1
            carry = t.slice(at[-1])
            if carry.num_rows > PROBES_AT_ONCE and role[at[-1]] == 0 and role[-1] == 1:
                out = part(t, role, at[-1], ends[-1], fresh)
                if out is not None:
                    yield out
                carry, fresh = carry.slice(0, int(np.count_nonzero(role[at[-1]:] == 0))), False
            elif role[at[-1]] == 1:  # no index row in this bucket
                carry = carry.slice(0, 1)
        if carry is not None and carry.num_rows > 1:
            role = carry["role"].to_numpy()
            if role[0] == 0:
                out = part(carry, role, 0, len(role), fresh)
                if out is not None:
                    yield out

    def part(t, role, lo, hi, fresh):
        own = int(np.count_nonzero(role[lo:hi] == 0))
        if own == hi - lo and not fresh:
            return None
        return fn(t.slice(lo, own), t.slice(lo + own, hi - lo - own), fresh)

    return dealt.mapInArrow(run, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of n nodes over links a-b."""
    own = np.arange(n)
    while len(a):
        left, right = own[a], own[b]
        apart = left != right
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(own, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(up := own[own], own):
            own = up
    return own

"""SimHash near-duplicates, found by multi-index hashing.

``fingerprints`` turns each text into 64 majority bits over the XXH64 hashes of
its word shingles. ``near_duplicates`` cuts the fingerprints into segments; two
fingerprints within ``bits`` differing bits agree in some segment up to
``bits // segments`` bits, so every fingerprint is stored under its segments,
looked up under each value in a small Hamming ball around them, and each match
is verified over all 64 bits. Texts with one fingerprint are one node, and a
bucket returns a spanning forest of its links, so groups of copies or near
copies are never expanded into pairs.

Defined cases: a null or empty text has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; repeated rows share their
result; rows with a null id link others but have component null if no row of
the group has an id; an empty table gives an empty result. Only the id and text
columns are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.blocks import compare, deal, roots
from claimweave.llm.components import components
from claimweave.llm.textbatch import slices
from claimweave.sources.sinks import stage

SHINGLE, BITS, SEED = 3, 3, 42
SEGMENTS = 2
BLOCK_ROWS = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the hashes of all word shingles, unsigned."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for words in slices(text.lower()):
        words = tail + words
        tail = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
        if len(words) < shingle:
            tail = words
            continue
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, len(words) - shingle + 1)
        n += len(h)
        for lo in range(0, len(h), 1 << 14):
            part = np.unpackbits(h[lo:lo + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64)
            ones += part.sum(axis=0, dtype=np.uint16)
    if not n:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), seed)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (t.as_py() or b"" for t in b.column(1))
            fps = np.fromiter((fingerprint(t, shingle, seed) for t in texts), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _segments(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    cut = [round(i * 64 / segments) for i in range(segments + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cut, cut[1:], strict=False)]


def _value(lo: int, width: int):
    return F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))


def _ball(width: int, radius: int) -> list[int]:
    """Masks of 1 to ``radius`` bits."""
    return [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(width), r)]


def _near(value, width: int, radius: int):
    """The larger values within ``radius`` bits: a pair is probed from its smaller side."""
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
    return F.filter(F.transform(masks, lambda m: value.bitwiseXOR(m)), lambda x: x > value)


def buckets(fps: DataFrame, bits: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """Index and probe rows (key, id, fp) of distinct fingerprints."""
    radius, index, probe = bits // segments, [], []
    for k, (lo, width) in enumerate(_segments(segments)):
        value = _value(lo, width)
        index.append(fps.select(F.xxhash64(F.lit(k), value).alias("key"), F.col("fp").alias("id"), "fp"))
        near = fps.select("fp", F.explode(_near(value, width, radius)).alias("v")) if radius else fps.select(
            "fp", value.alias("v")).limit(0)
        probe.append(near.select(F.xxhash64(F.lit(k), "v").alias("key"), F.col("fp").alias("id"), "fp"))
    return reduce(DataFrame.union, index), reduce(DataFrame.union, probe)


def _forest(bits: int):
    def run(index: pa.Table, probe: pa.Table, fresh: bool) -> pa.RecordBatch | None:
        own = np.unique(index["fp"].to_numpy()).view(np.uint64)
        every = np.unique(np.concatenate([index["fp"].to_numpy(), probe["fp"].to_numpy()])).view(np.uint64)
        lefts, rights = [], []
        for lo in range(0, len(own), 256):
            a, b = np.nonzero(np.bitwise_count(own[lo:lo + 256, None] ^ every[None, :]) <= bits)
            lefts.append(np.searchsorted(every.view(np.int64), own[lo + a].view(np.int64)))
            rights.append(b)
        root = roots(len(every), np.concatenate(lefts), np.concatenate(rights))
        at = np.flatnonzero(root != np.arange(len(every)))
        if not len(at):
            return None
        fp = every.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[root[at]])], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS, seed: int = SEED, segments: int = SEGMENTS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; the component is the
    smallest id reachable over fingerprints at ``bits`` or fewer differing bits."""
    own = stage(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = stage(own.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct_fingerprints")
    index, probe = buckets(nodes.select("fp"), bits, segments)
    linked = components(compare(deal(index, probe, block_rows), _forest(bits), "a long, b long"))
    linked = linked.withColumnRenamed("node", "fp")
    lows = nodes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = lows.groupBy("component").agg(F.min("low").alias("component_id"))
    place = stage(lows.join(least, "component").select("fp", "component_id"), "fingerprint_components")
    return own.join(place, "fp").select("doc_id", "fp", "component_id")

"""Hard negatives by segment summary filtering.

Each vector is cut into segments, and the mean and deviation of every segment
are stored with it. For a segment of w entries the inner product lies between
``w * (mean * mean' - dev * dev')`` and ``w * (mean * mean' + dev * dev')``, so
sums over segments bound a score without the vector. Bounds start on few wide
segments and are refined on more of them; a pair that no search can use any more
is left, and what remains is scored exactly, in whole numbers.

Two searches run one after the other, each over all rows: the best rows of an
anchor's own label (its positives), then for each positive the best rows of other
labels whose score lies in a band below the positive's. Anchors are dealt into
blocks and rows into slices of bounded size; a cell holds one block and one
slice, and every block meets every slice. So no label, however frequent, is one
task, and the driver sees no row. The work grows with anchors times rows.

Scores are inner products of the vectors' components as ``floor(scale * x)``.

Defined cases: rows with a null id or label, or a vector that is null, empty or
holds null or non-finite components take no part; vectors of different lengths
are not compared; rows that repeat id, label and vector are one, and rows that
share an id are never each other's positive or negative; ties go to the smaller
id; an anchor without positives, or a positive without negatives, gives no row;
scores beyond 2^62 are an error. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.vectors import finite, matrix
from claimweave.sources.sinks import stage

#: Segments of a vector, coarse to fine; each number divides the next.
LEVELS = (2, 8, 32)
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative scores from LOW to HIGH percent of its positive.
LOW, HIGH = 50, 95
ANCHORS_PER_BLOCK = 2048
ROWS_PER_SLICE = 8192
_TILE, _FIRST_TILE = 512, 64
#: Above this share of surviving pairs, whole tiles are scored.
_DENSE = 0.05
_PAIRS_AT_ONCE = 1 << 16
_FAR = 1 << 62
_CELL = ("part", "size", "block", "slice")


def _widths(size: int) -> np.ndarray:
    return np.diff(np.arange(LEVELS[-1] + 1) * size // LEVELS[-1])


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each row's finest segments; empty ones are 0."""
    width = _widths(x.shape[1])
    used = width > 0
    at, wide = np.cumsum(width)[used] - width[used], width[used]
    mean, dev = np.zeros((2, len(x), len(width)))
    mean[:, used] = np.add.reduceat(x, at, axis=1) / wide
    rest = x - np.repeat(mean[:, used], wide, axis=1)
    dev[:, used] = np.sqrt(np.add.reduceat(rest * rest, at, axis=1) / wide)
    return mean, dev


def coarser(mean: np.ndarray, dev: np.ndarray, width: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations and widths of ``n`` segments from those of finer ones."""
    by = lambda a: a.reshape(*a.shape[:-1], n, -1)
    wide = by(width).sum(axis=-1)
    own = by(mean * width).sum(axis=-1) / np.maximum(wide, 1)
    apart = by(mean) - own[..., None]
    var = ((by(dev) ** 2 + apart * apart) * by(width)).sum(axis=-1) / np.maximum(wide, 1)
    return own, np.sqrt(var), wide


class _Cell:
    """One block of anchors and the best rows met so far.

    ``low`` and ``high`` hold a band of scores for each anchor and search.
    """

    def __init__(self, same: bool, keep: int):
        self.same, self.keep, self.batches, self.ready = same, keep, [], False

    def add(self, rows: pa.RecordBatch) -> None:
        self.batches.append(rows)

    def _prepare(self) -> None:
        t = pa.Table.from_batches(self.batches).combine_chunks()
        size = t["size"][0].as_py()
        part = lambda name: t[name].combine_chunks()
        self.id, self.label = t["id"].to_numpy(), t["label"].to_numpy()
        self.x = np.floor(SCALE * matrix(part("vector"), size))
        mean, dev = (matrix(part(c), LEVELS[-1]) for c in ("mean", "dev"))
        self.width = _widths(size)
        self.summary = [coarser(mean, dev, self.width, n) for n in LEVELS]
        bands = t["bands"].to_pylist()
        self.searches = max(len(b) for b in bands)
        # An anchor with fewer searches than another has empty bands in their place.
        fill = lambda k, none: np.array([[b[p][k] if p < len(b) else none for p in range(self.searches)] for b in bands])
        self.key, self.low, self.high = fill("key", 0), fill("low", 1), fill("high", 0)
        self.floor = self.low.copy()
        none = np.zeros(0, np.int64)
        self.best = [(none, none, none)] * self.searches
        self.largest, self.batches, self.ready = np.abs(self.x).max(initial=0), [], True

    def meet(self, rows: pa.RecordBatch) -> None:
        if not rows.num_rows or not (self.ready or self.batches):
            return
        if not self.ready:
            self._prepare()
        cuts = [0, *range(_FIRST_TILE, rows.num_rows, _TILE), rows.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                self._tile(rows.slice(lo, hi - lo))

    def _tile(self, rows: pa.RecordBatch) -> None:
        own, label = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        x = np.floor(SCALE * matrix(rows.column("vector"), self.x.shape[1]))
        mean, dev = (matrix(rows.column(c), LEVELS[-1]) for c in ("mean", "dev"))
        most = self.largest * np.abs(x).max() * x.shape[1]
        if most >= _FAR:
            raise ValueError("scores beyond 2^62: scale the vectors down")
        alive = (self.label[:, None] == label) == self.same
        alive &= self.id[:, None] != own
        cols = np.arange(len(own))
        size = np.sqrt((self.x * self.x).sum(axis=1).max() * (x * x).sum(axis=1).max())
        slack = 1e-9 * size + 1e-6
        for n, (qm, qd, wide) in zip(LEVELS, self.summary, strict=True):
            some = alive.any(axis=0)
            alive, cols, mean, dev = alive[:, some], cols[some], mean[some], dev[some]
            if not len(cols):
                return
            m, d, _ = coarser(mean, dev, self.width, n)
            middle, spread = (qm * wide) @ m.T, (qd * wide) @ d.T
            spread += slack
            upper = middle + spread
            lower = np.subtract(middle, spread, out=middle)
            useful = np.zeros_like(alive)
            for p in range(self.searches):
                if n == LEVELS[-1] and len(cols) > self.keep:
                    # So many rows surely lie in the band that lower bounds raise its floor.
                    sure = np.where(alive & (lower >= self.low[:, p, None]) & (upper <= self.high[:, p, None]), lower, -np.inf)
                    kth = np.partition(sure, -self.keep, axis=1)[:, -self.keep]
                    known = np.isfinite(kth)
                    self.floor[known, p] = np.maximum(self.floor[known, p], np.floor(kth[known]).astype(np.int64))
                useful |= (upper >= self.floor[:, p, None]) & (lower <= self.high[:, p, None])
            alive &= useful
        i, j = np.nonzero(alive)
        if len(i):
            # Doubles hold these sums exactly, or else longs do.
            kind = np.float64 if most < 2 ** 53 else np.int64
            self._score(i, x[cols].astype(kind), own[cols], j, len(i) > _DENSE * alive.size)

    def _score(self, i: np.ndarray, x: np.ndarray, own: np.ndarray, j: np.ndarray, dense: bool) -> None:
        q = self.x.astype(x.dtype, copy=False)
        if dense:
            score = (q @ x.T)[i, j]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", q[i[k:k + _PAIRS_AT_ONCE]], x[j[k:k + _PAIRS_AT_ONCE]])
                                    for k in range(0, len(i), _PAIRS_AT_ONCE)])
        score = score.astype(np.int64)
        for p in range(self.searches):
            use = (score >= self.floor[i, p]) & (score <= self.high[i, p])
            if not use.any():
                continue
            a, s, o = (np.concatenate(x) for x in zip(self.best[p], (i[use], score[use], own[j[use]]), strict=True))
            order = np.lexsort((o, -s, a))
            a, s, o = a[order], s[order], o[order]
            begin = np.searchsorted(a, a, side="left")
            first = np.arange(len(a)) - begin < self.keep
            self.best[p] = a[first], s[first], o[first]
            last = np.flatnonzero(np.arange(len(a)) - begin == self.keep - 1)
            self.floor[a[last], p] = np.maximum(self.floor[a[last], p], s[last])

    def found(self) -> Iterator[pa.RecordBatch]:
        for p in range(self.searches if self.ready else 0):
            a, s, o = self.best[p]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.id[a], self.key[a, p], o, s)],
                                                 ["anchor_id", "key", "id", "score"])


def _search(cells: DataFrame, same: bool, keep: int) -> DataFrame:
    """(anchor_id, key, id, score): in each cell, the ``keep`` best rows of every
    anchor and search, whose label is the anchor's (``same``) or another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, at = _Cell(same, keep), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in _CELL])
            role = batch.column("role").to_numpy()
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if tuple(keys[:, lo]) != at:
                    yield from cell.found()
                    cell, at = _Cell(same, keep), tuple(keys[:, lo])
                own = int(np.count_nonzero(role[lo:hi] == 0))
                if own:
                    cell.add(batch.slice(lo, own))
                cell.meet(batch.slice(lo + own, hi - lo - own))
        yield from cell.found()

    return cells.mapInArrow(run, "anchor_id long, key long, id long, score long")


def _cells(rows: DataFrame, anchors: DataFrame, part: Column) -> DataFrame:
    """Anchors (role 0) and rows (role 1) by cell; both are compared within ``part``."""
    rows, anchors = rows.withColumn("part", part), anchors.withColumn("part", part)
    many = lambda n, most: F.ceil(F.col(n) / most).cast("long")
    dealt = rows.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("n_anchors")) \
        .filter("n_anchors > 0").select("part", "size", many("n", ROWS_PER_SLICE).alias("slices"),
                                        many("n_anchors", ANCHORS_PER_BLOCK).alias("blocks"))
    dealt = stage(dealt, "cells")
    pick = ["part", "size", "block", "slice", "role", "id", "label", "vector", "mean", "dev", "bands"]
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    met = rows.join(dealt, ["part", "size"]).withColumns({"slice": place("slices", 1), "role": F.lit(1)}) \
        .withColumn("block", every("blocks")).withColumn("bands", F.lit(None).cast(anchors.schema["bands"].dataType))
    own = anchors.join(dealt, ["part", "size"]).withColumns({"block": place("blocks", 2), "role": F.lit(0)}) \
        .withColumn("slice", every("slices"))
    return own.select(*pick).union(met.select(*pick)).repartition(*_CELL).sortWithinPartitions(*_CELL, "role")


def summarised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               label: Column | None = None) -> DataFrame:
    """(id, label, vector, size, mean, dev) of the rows that take part, written once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), (F.col(label_col) if label is None else label).cast("long").alias("label"),
                          F.col(vector_col).alias("vector"), F.col(label_col).isNotNull().alias("labelled"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("labelled") & finite(F.col("vector")))
    rows = rows.select("id", "label", "vector", F.size("vector").cast("long").alias("size"))
    kind = rows.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("size").to_numpy()
            for n in np.unique(size):
                own = batch.take(pa.array(np.flatnonzero(size == n)))
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(s.ravel()), LEVELS[-1]).cast(pa.list_(pa.float64()))
                         for s in summaries(np.floor(SCALE * matrix(own.column("vector"), n)))]
                yield pa.RecordBatch.from_arrays([*own.columns, *lists], [*own.schema.names, "mean", "dev"])

    # Rows that repeat id, label and vector are one.
    out = rows.distinct().mapInArrow(run, f"id long, label long, vector {kind}, size long, mean array<double>, dev array<double>")
    return stage(out, "segment_summaries")


def _best(found: DataFrame, by: list[str], keep: int, name: str) -> DataFrame:
    """The ``keep`` best of what the cells found, ranked; a group has at most ``keep`` rows a cell."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return stage(found.dropDuplicates([*by, "id", "score"]).withColumn("rank", F.row_number().over(order).cast("int"))
                 .filter(F.col("rank") <= keep), name)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says of a row, by its column ``id``, whether it is an anchor;
    ``label`` replaces the label column's value where that is not null.
    """
    rows = summarised(vectors, id_col, vector_col, label_col, label).withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    own = rows.filter("anchor")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(-_FAR).alias("low"), F.lit(_FAR).alias("high")))
    met = _search(_cells(rows, own.withColumn("bands", whole), F.col("label")), True, POSITIVES)
    positives = _best(met, ["anchor_id"], POSITIVES, "positives")
    # LOW * p <= 100 * n <= HIGH * p in whole numbers, without leaving a long: floor and remainder of p / 100 apart.
    p = F.col("score")
    hundreds, rest = F.expr("score div 100 - if(score % 100 < 0, 1, 0)"), F.pmod(p, F.lit(100))
    low = hundreds * LOW + F.ceil(rest * LOW / 100).cast("long")
    high = hundreds * HIGH + F.floor(rest * HIGH / 100).cast("long")
    bands = positives.select("anchor_id", "score", F.struct(F.col("id").alias("key"), low.alias("low"), high.alias("high")).alias("band"))
    bands = bands.groupBy("anchor_id").agg(F.collect_list("band").alias("bands"))
    again = own.join(bands, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    met = _search(_cells(rows, again, F.lit(0).cast("long")), False, NEGATIVES)
    negatives = _best(met, ["anchor_id", "key"], NEGATIVES, "negatives")
    scores = positives.select("anchor_id", F.col("id").alias("key"), F.col("score").alias("positive_score"))
    return negatives.join(scores, ["anchor_id", "key"]).select(
        "anchor_id", F.col("key").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

The word n-grams of the benchmark are a table. A first pass over the corpus counts
in how many documents each occurs, joined by hash. The rare ones of an item are its
seeds: n-grams in at most ``RARE_DOCS`` documents or ``RARE_SHARE`` of them, or in
at most ``RARE_FACTOR`` times as many as the item's median n-gram, so that an item's
own copies don't make it common. A second pass joins the corpus' n-grams to the
seeds; each meeting names a stretch of a text that may hold an item. The words of
that stretch are joined to the item's and aligned by Smith-Waterman; an item whose
best alignment reaches ``least`` of the score of a full copy, or the score of
``passage`` equal words, contaminates the document, be the copy exact, edited or
paraphrased, whole or a passage of a long item.

Both passes read whole texts. What they send to the joins is first held against a
filter of at most ``_MOST_BITS`` bits, whatever the benchmark's size: it lets every
n-gram of the benchmark through, and few others. Neither items nor n-grams go to
the driver or into a task's closure. Equal texts are aligned once, and so are equal
items. Keys that hold a large share of a join's rows are salted. A text's stretches
meet its words in one task, which reads a long text in pieces.

Words are compared in lower case (A-Z) and without punctuation at their ends.

Defined cases: null and empty texts match nothing; neither do items with fewer
words than a seed; an item with a null id is left out; repeated items and rows
give repeated matches; an empty benchmark or table matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.textbatch import chain, pieces
from claimweave.operators import salted_join, semi_in_filtered
from claimweave.sources.sinks import stage

SEED_WORDS = 3
RARE_DOCS, RARE_SHARE, RARE_FACTOR = 100, 0.001, 4
LEAST = 0.5
#: An alignment that scores as so many equal words is a copied passage, whatever the item's length.
PASSAGE = 30
MATCH, MISMATCH, GAP = 2, -1, 1
#: Bits of the n-gram filter: so many for each n-gram, within these powers of two.
_BITS_EACH, _LEAST_BITS, _MOST_BITS = 64, 16, 27
#: Words that one call aligns, about.
_CELLS = 1 << 20
#: Bytes of stretches that one batch holds, about.
_BATCH = 8 << 20
_NO_WORDS = np.zeros(0, np.uint64)


def _grams(column: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(rows, numbers of the words at which n-grams begin, n-gram hashes, whether the
    texts end) of the texts of a binary column; a long text comes in pieces."""
    held, before = _NO_WORDS, 0
    for t, opens, ends in pieces(column):
        t = t.trimmed()
        if t.n > 1:
            _, at, g = t.grams(n)
            yield t.rows[t.doc[at]], at - t.firsts()[t.doc[at]], g, True
            continue
        if opens:
            held, before = _NO_WORDS, 0
        own = t.hashes()
        h = np.concatenate([held, own])
        k = max(0, len(h) - n + 1)
        g = chain([h[i:i + k] for i in range(n)]) if k else _NO_WORDS
        yield np.repeat(t.rows, k), np.arange(k) + before - len(held), g, ends
        held, before = h[max(0, len(h) - n + 1):], before + len(own)


class GramFilter:
    """Which n-grams may be in a table: a bit for each value of a hash's leading bits."""

    def __init__(self, grams: DataFrame):
        own = grams.select("gram").distinct()
        self.bits = min(_MOST_BITS, max(_LEAST_BITS, (own.count() * _BITS_EACH).bit_length()))
        at = F.shiftrightunsigned("gram", 64 - self.bits)
        # At most 2^(_MOST_BITS - 6) rows.
        got = own.groupBy(F.shiftright(at, 6).alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("set")).toArrow()
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        self.words[got["word"].to_numpy()] = got["set"].to_numpy().astype(np.int64).view(np.uint64)

    def may_hold(self, grams: np.ndarray) -> np.ndarray:
        at = grams >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def _items(benchmark: DataFrame, id_col: str, text_col: str, n: int) -> tuple[DataFrame, DataFrame]:
    """(``item``, ``item_id``) of the benchmark's rows, and (``item``, ``words``, ``m``) of
    their different word sequences."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column(0), []
            for t, _, ends in pieces(batch.column(1)):
                t = t.trimmed()
                cut, h = t.firsts(), t.hashes()
                if t.n == 1:
                    held.append(h.tobytes())
                    if not ends:
                        continue
                    own, held = [b"".join(held)], []
                else:
                    own = [h[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                yield _batch(item_id=ids.take(pa.array(t.rows)), words=pa.array(own, pa.binary()))

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    rows = rows.filter("item_id is not null and text is not null").mapInArrow(words, "item_id long, words binary")
    rows = stage(rows.filter(F.octet_length("words") >= 8 * n), "benchmark_items")
    classes = rows.select("words").distinct().withColumn("item", F.monotonically_increasing_id())
    classes = stage(classes.withColumn("m", (F.octet_length("words") / 8).cast("long")), "benchmark_classes")
    key = lambda: F.xxhash64("words")
    mine = classes.select(F.col("words").alias("same"), "item", key().alias("k"))
    members = salted_join(stage(rows.withColumn("key", key()), "benchmark_keys"), mine, "key", "k", "inner")
    return stage(members.filter("words = same").select("item", "item_id"), "benchmark_members"), classes


def _item_grams(classes: DataFrame, n: int) -> DataFrame:
    """(item, m, offset, gram): the n-grams of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, m, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = np.frombuffer(words, np.uint64)
                k = len(h) - n + 1
                yield _batch(item=np.full(k, item), m=np.full(k, m), offset=np.arange(k), gram=chain([h[i:i + k] for i in range(n)]).view(np.int64))

    return classes.select("item", "m", "words").mapInArrow(run, "item long, m long, offset long, gram long")


def _occurrences(texts: DataFrame, grams: GramFilter, n: int) -> DataFrame:
    """(gram, docs, times): the documents that hold it and how often they do, for the
    n-grams that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            for row, _, g, ends in _grams(batch.column(0), n):
                some = grams.may_hold(g)
                rows.append(row[some])
                kept.append(g[some])
                if not ends:
                    continue
                row, g = np.concatenate(rows), np.concatenate(kept)
                rows, kept = [], []
                if not len(g):
                    continue
                order = np.lexsort((row, g))
                row, g = row[order], g[order]
                new = np.concatenate([[True], g[1:] != g[:-1]])
                fresh = new | np.concatenate([[True], row[1:] != row[:-1]])
                at = np.flatnonzero(new)
                yield _batch(gram=g[at].view(np.int64), docs=np.add.reduceat(fresh.astype(np.int64), at),
                             times=np.diff(np.append(at, len(g))))

    return texts.mapInArrow(run, "gram long, docs long, times long").groupBy("gram").agg(
        F.sum("docs").alias("docs"), F.sum("times").alias("times"))


def seeds(docs: DataFrame, classes: DataFrame, text_col: str = "text", words: int = SEED_WORDS) -> DataFrame:
    """(gram, item, m, offset, times): the rare n-grams of the items; rarity is counted over all of ``docs``."""
    own = stage(_item_grams(classes, words), "benchmark_grams")
    counts = _occurrences(docs.select(F.col(text_col).cast("binary").alias("text")), GramFilter(own), words)
    met = salted_join(own, counts.withColumnRenamed("gram", "g"), "gram", "g", "left").drop("g")
    met = stage(met.fillna(0, ["docs", "times"]), "benchmark_counts")
    middle = met.groupBy(F.col("item").alias("of")).agg(F.median("docs").alias("median"))
    most = F.greatest(RARE_FACTOR * F.col("median"), F.lit(float(max(RARE_SHARE * docs.count(), RARE_DOCS))))
    return stage(met.join(middle, F.col("item") == F.col("of")).filter(F.col("docs") <= most)
                 .select("gram", "item", "m", "offset", "times"), "seeds")


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that tell texts apart; null for a null text."""
    return [F.when(text.isNotNull(), F.xxhash64(text)), F.when(text.isNotNull(), F.xxhash64(F.lit(1), text))]


def _hits(texts: DataFrame, grams: GramFilter, n: int) -> DataFrame:
    """(g, k1, k2, at): the n-grams of the texts (k1, k2, text) that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, g, _ in _grams(batch.column(2), n):
                some = grams.may_hold(g)
                if some.any():
                    row = pa.array(row[some])
                    yield _batch(g=g[some].view(np.int64), k1=batch.column(0).take(row), k2=batch.column(1).take(row), at=at[some])

    return texts.mapInArrow(run, "g long, k1 long, k2 long, at long")


def _places(texts: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """(k1, k2, item, m, stripe): where a text shares a seed with an item. Stripe s of
    an item of m words is its alignments that begin at words s*m to (s+1)*m - 1."""
    pairs = stage(found.groupBy("gram").agg((F.count(F.lit(1)) * F.max("times")).alias("pairs")), "seed_pairs")
    # Rows of the join by key are known, so keys of many are too: at most 2 for each partition.
    share = pairs.agg(F.sum("pairs")).first()[0] or 0
    piece = max(1, share // (2 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salts = {r["gram"]: -(-r["pairs"] // piece) for r in pairs.filter(F.col("pairs") > piece).collect()}
    met = salted_join(_hits(texts, GramFilter(found), n), found, "g", "gram", "inner", salts)
    stripe = F.floor((F.col("at") - F.col("offset")) / F.col("m")).alias("stripe")
    return stage(met.select("k1", "k2", "item", "m", stripe).distinct(), "places")


def _stretches(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(item, k1, k2, start, words, edges): the words of each place, of three times
    the item's length, from word ``start``, and the bytes where they begin and end."""
    wanted = places.select(F.col("k1").alias("key")).distinct()
    own = semi_in_filtered(texts, "k1", wanted, "key")
    own = own.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    spots = places.groupBy(F.col("k1").alias("p1"), F.col("k2").alias("p2")).agg(
        F.collect_list("item").alias("items"), F.collect_list("m").alias("sizes"), F.collect_list("stripe").alias("stripes"))
    own = own.join(spots, (F.col("k1") == F.col("p1")) & (F.col("k2") == F.col("p2")))

    def cut(text: pa.Array, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(place, first word, hashes, edges) of the words ``begin`` to ``end``; only those of open places are held."""
        order = np.argsort(begin, kind="stable")
        open_, at, low, byte = [], 0, 0, 0
        h, edges = _NO_WORDS, np.zeros((2, 0), np.int64)
        for t, _, last in pieces(text):
            size = int(t.end[0])
            t = t.trimmed()
            h, edges = np.concatenate([h, t.hashes()]), np.concatenate([edges, np.stack([t.start, t.start + t.length]) + byte], axis=1)
            byte += size
            while at < len(order) and (last or begin[order[at]] < low + len(h)):
                open_.append(order[at])
                at += 1
            still = []
            for i in open_:
                if last or end[i] <= low + len(h):
                    a, b = max(0, begin[i] - low), max(0, end[i] - low)
                    yield i, low + a, h[a:b], edges[:, a:b]
                else:
                    still.append(i)
            open_ = still
            to = min([low + len(h), *(int(begin[i]) for i in open_)])
            if to > low:
                h, edges, low = h[to - low:], edges[:, to - low:], to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r in range(batch.num_rows):
                k1, k2 = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                item, m, stripe = (batch.column(c)[r].values.to_numpy() for c in (3, 4, 5))
                begin = stripe * m - m // 2
                for i, start, h, edges in cut(batch.column(2).slice(r, 1), np.maximum(begin, 0), begin + 3 * m):
                    out.append((int(item[i]), k1, k2, int(start), h.tobytes(), edges.tobytes()))
                    size += 24 * len(h) + 64
                    if size > _BATCH:
                        yield made(out)
                        out, size = [], 0
            if out:
                yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["item", "k1", "k2", "start", "words", "edges"])

    own = own.select("k1", "k2", "text", "items", "sizes", "stripes")
    return own.mapInArrow(run, "item long, k1 long, k2 long, start long, words binary, edges binary")


def _align(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best Smith-Waterman score of each row of ``items`` against the same row of ``windows``."""
    slope = GAP * np.arange(windows.shape[1], dtype=np.int32)
    above = np.zeros(windows.shape, np.int32)
    best = np.zeros(len(windows), np.int32)
    for word in items.T:
        now = np.where(windows == word[:, None], MATCH, MISMATCH).astype(np.int32)
        now[:, 1:] += above[:, :-1]
        np.maximum(now, above - GAP, out=now)
        np.maximum(now, 0, out=now)
        above = np.maximum.accumulate(now + slope, axis=1) - slope
        np.maximum(best, above.max(axis=1), out=best)
    return best


def _span(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Words of one window that the best alignment covers. Two sweeps that keep one row:
    forward for where it ends, and back from there for where it began."""
    slope = GAP * np.arange(len(window) + 1, dtype=np.int32)
    above, best = np.zeros(len(window) + 1, np.int32), (0, 0, 0)
    for i, word in enumerate(item, 1):
        now = np.zeros(len(window) + 1, np.int32)
        now[1:] = np.maximum(above[:-1] + np.where(window == word, MATCH, MISMATCH), above[1:] - GAP)
        above = np.maximum.accumulate(np.maximum(now, 0) + slope) - slope
        j = int(above.argmax())
        if above[j] > best[0]:
            best = (int(above[j]), i, j)
    score, i, end = best
    back, slope = window[:end][::-1], slope[:end + 1]
    above = -slope
    for k, word in enumerate(item[:i][::-1], 1):
        now = np.full(end + 1, -GAP * k, np.int32)
        now[1:] = np.maximum(above[:-1] + np.where(back == word, MATCH, MISMATCH), above[1:] - GAP)
        above = np.maximum.accumulate(now + slope) - slope
        met = np.flatnonzero(above == score)
        if len(met):
            return end - int(met[0]), end
    return 0, 0


def _aligned(rows: DataFrame, least: float, passage: int) -> DataFrame:
    """(k1, k2, item, score, start, begin, end) of the stretches that reach a match; of
    those of one text and item that a batch holds, the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, k1, k2, start, mine, theirs, edges = batch.columns
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in mine]
            words = [np.frombuffer(x.as_buffer(), np.uint64) for x in theirs]
            size = np.array([len(x) for x in own])
            score = np.zeros(len(own), np.int64)
            for m in np.unique(size):
                same = np.flatnonzero(size == m)
                at_once = max(1, _CELLS // (3 * int(m)))
                for part in np.split(same, range(at_once, len(same), at_once)):
                    windows = np.zeros((len(part), 3 * m), np.uint64)
                    for row, i in zip(windows, part, strict=True):
                        row[:len(words[i])] = words[i]
                    score[part] = _align(np.stack([own[i] for i in part]), windows)
            best: dict[tuple, int] = {}
            at = start.to_numpy()
            for i in np.flatnonzero(score >= MATCH * np.minimum(least * size, passage)):
                key = (k1[i].as_py(), k2[i].as_py(), item[i].as_py())
                old = best.get(key)
                if old is None or (score[i], -at[i]) > (score[old], -at[old]):
                    best[key] = i
            out = []
            for key, i in best.items():
                a, b = _span(own[i], words[i])
                edge = np.frombuffer(edges[i].as_buffer(), np.int64).reshape(2, -1)
                out.append((*key, score[i] / (MATCH * size[i]), int(at[i]), int(edge[0, a]), int(edge[1, b - 1])))
            if out:
                kinds = [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["k1", "k2", "item", "score", "start", "begin", "end"])

    return rows.mapInArrow(run, "k1 long, k2 long, item long, score double, start long, begin long, end long")


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
            item_text_col: str = "text", least: float = LEAST, passage: int = PASSAGE,
            words: int = SEED_WORDS) -> DataFrame:
    """(k1, k2, item_id, score, begin, end) of the texts of ``docs``, named by ``text_key``, that
    hold an item: the score (1 for a full copy) and the bytes ``begin`` to ``end`` that the best alignment covers."""
    members, classes = _items(benchmark, item_id_col, item_text_col, words)
    text = F.col(text_col).cast("string")
    key = text_key(text)
    texts = docs.filter(text.isNotNull()).select(key[0].alias("k1"), key[1].alias("k2"), text.cast("binary").alias("text"))
    places = _places(texts, seeds(docs, classes, text_col, words), words)
    rows = stage(_stretches(texts, places), "stretches")
    of = classes.select(F.col("item").alias("of"), F.col("words").alias("mine"))
    met = salted_join(rows, of, "item", "of", "inner").select("item", "k1", "k2", "start", "mine", "words", "edges")
    best = _aligned(met, least, passage).groupBy("k1", "k2", "item").agg(
        F.max(F.struct("score", (-F.col("start")).alias("s"), "begin", "end")).alias("b"))
    best = stage(best.select("k1", "k2", "item", "b.score", "b.begin", "b.end"), "matches_of_classes")
    named = salted_join(best, members.withColumnRenamed("item", "of"), "item", "of", "inner")
    return stage(named.select("k1", "k2", "item_id", "score", "begin", "end"), "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = LEAST, passage: int = PASSAGE) -> DataFrame:
    """(doc_id, item_id, score, begin, end): one row for each document and item it holds."""
    found = matches(docs, benchmark, text_col, least=least, passage=passage)
    key = text_key(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("doc_id"), key[0].alias("d1"), key[1].alias("d2"))
    rows = semi_in_filtered(rows, "d1", found.select(F.col("k1").alias("key")).distinct(), "key")
    met = salted_join(rows, found, "d1", "k1", "inner").filter("d2 = k2")
    return met.select("doc_id", "item_id", "score", "begin", "end")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = matches(docs, benchmark, text_col).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    key = text_key(F.col(text_col).cast("string"))
    return docs.join(stage(found, "contaminated_texts"), (key[0] == F.col("_k1")) & (key[1] == F.col("_k2")), "left_anti")

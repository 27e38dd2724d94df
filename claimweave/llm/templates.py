"""Line dedup by a fixed-depth log-template tree.

A line's words are parsed down a tree: its word count, then its first ``DEPTH``
words. Words that hold a digit are wildcards, unless they are over half of the
line. The lines of one leaf are generalised to templates: of a line's later
positions those whose word is rarest among the leaf's different lines are variable
fields, as long as it is rarer than the most frequent of them and at least
``SIMILARITY`` of the words stay. Lines of one leaf with the same fields and equal
words elsewhere are one template, so its lines always agree in that share of their
words; equal lines always are one.

A template that occurs in ``least_docs`` or more documents recurs (lines of under
``SHORT`` words: in ``short_docs``): it stays in its first document (smallest id),
once, and is dropped everywhere else, so text that only copies hold is never lost
altogether.

Texts are read twice. The first pass writes each line's leaf and signature (two
64-bit hashes); the second gives the words of lines in leaves that hold several
different ones, found by a bitmap of fixed size, whose wrong hits a join takes out.
All else is counting: the work of a leaf grows with its lines, however many are in
one, and no leaf or template is gathered in a task.

Defined cases: null and empty texts have no lines to drop; lines without a word
are left alone; a template that recurs within one document only is kept; rows
with a null id are left alone; rows that repeat an id are one document; an empty
table gives an empty result; long texts are read in pieces cut at line breaks.
Lines end at ``\\n``. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.textbatch import Texts, chain, mix, pieces
from claimweave.operators import salted_join
from claimweave.sources.sinks import stage

DEPTH, SIMILARITY, LEAST_DOCS = 3, 0.8, 2
#: Lines of fewer words recur if so many documents hold them.
SHORT, SHORT_DOCS = 3, 10
#: Bits of the map of leaves with several lines (8 MiB); with more such leaves than
#: a tenth of it, more words than needed are read, and the join drops them.
LEAF_BITS = 26
_MAP_BITS = 15  # of one of Spark's bitmaps
_WILD = np.uint64(0x5EED)


class Lines:
    """The lines of a run of texts that have a word; ``before`` counts the line
    breaks before a piece of a long text."""

    def __init__(self, t: Texts, depth: int, before: int = 0):
        digit = np.concatenate([[0], np.cumsum((t.buf >= 0x30) & (t.buf <= 0x39))])
        h = t.hashes()
        ends = np.flatnonzero(t.raw == 10)
        line = np.searchsorted(ends, t.start)
        self.first = np.flatnonzero(np.diff(line, prepend=-1))
        self.size = np.diff(np.append(self.first, len(line)))
        wild = digit[t.start + t.length] > digit[t.start]
        many = np.add.reduceat(wild, self.first, dtype=np.int64) if len(h) else np.zeros(0, np.int64)
        h[wild & np.repeat(2 * many <= self.size, self.size)] = _WILD
        self.doc = t.doc[self.first]
        self.number = line[self.first] - np.searchsorted(ends, t.begin[self.doc]) + before
        place = np.arange(len(h)) - np.repeat(self.first, self.size)
        with np.errstate(over="ignore"):
            salted = mix(h + (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            total = np.add.reduceat(salted, self.first) if len(h) else np.zeros(0, np.uint64)
        self.sig = mix(total + self.size.astype(np.uint64)).view(np.int64)
        lead = [self.size.astype(np.uint64)]
        for k in range(depth):
            at = np.minimum(self.first + k, max(len(h) - 1, 0))
            lead.append(np.where(k < self.size, h[at] if len(h) else np.uint64(0), np.uint64(0)))
        self.leaf = chain(lead).view(np.int64)
        self.words = h.view(np.int64)


def _lines(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[Lines, np.ndarray]]:
    """(lines, ids of their documents) of a batch (doc_id, text)."""
    ids, before = batch.column(0).to_numpy(), 0
    for t, opens, _ in pieces(batch.column(1), lines=True):
        before = 0 if opens else before
        lines = Lines(t, depth, before)
        before += int(np.count_nonzero(t.raw[:-1] == 10))
        yield lines, ids[t.rows[lines.doc]]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))


def _all_lines(rows: DataFrame, depth: int) -> DataFrame:
    """(doc_id, line, leaf, sig, size) of every line with a word, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines, ids in _lines(batch, depth):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(lines.number), pa.array(lines.leaf), pa.array(lines.sig), pa.array(lines.size)],
                    ["doc_id", "line", "leaf", "sig", "size"])

    return stage(rows.mapInArrow(run, "doc_id long, line long, leaf long, sig long, size long"), "lines")


def _bitmap(leaves: DataFrame) -> np.ndarray:
    """Bits of the leaves' low bits, built by Spark in maps of fixed size."""
    bit = F.col("leaf").bitwiseAND(F.lit((1 << LEAF_BITS) - 1))
    maps = leaves.select(F.shiftright(bit, _MAP_BITS).alias("map"), bit.bitwiseAND(F.lit((1 << _MAP_BITS) - 1)).alias("bit")) \
        .groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(1 << LEAF_BITS - 3, np.uint8)
    for row in maps.collect():
        at = row["map"] << _MAP_BITS - 3
        out[at:at + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return out


def _words(rows: DataFrame, leaves: DataFrame, depth: int, least: int) -> DataFrame:
    """(leaf, sig, words) of the different lines of at least ``least`` words in ``leaves``."""
    bits = _bitmap(leaves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines, _ in _lines(batch, depth):
                at = lines.leaf & ((1 << LEAF_BITS) - 1)
                met = np.flatnonzero((lines.size >= least) & (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0))
                met = met[np.unique(lines.sig[met], return_index=True)[1]]
                if not len(met):
                    continue
                size = lines.size[met]
                offsets = np.append(0, np.cumsum(size))
                place = np.arange(offsets[-1]) + np.repeat(lines.first[met] - offsets[:-1], size)
                words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(lines.words[place]))
                yield pa.RecordBatch.from_arrays([pa.array(lines.leaf[met]), pa.array(lines.sig[met]), words],
                                                 ["leaf", "sig", "words"])

    found = rows.mapInArrow(run, "leaf long, sig long, words array<long>").join(leaves, "leaf", "left_semi")
    return stage(found.dropDuplicates(["sig"]), "leaf_words")


def generalised(words: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(sig, template) of different lines (leaf, sig, words)."""
    each = words.select("leaf", "sig", F.posexplode("words").alias("at", "word")).filter(F.col("at") >= depth)
    counts = each.groupBy("leaf", "at", "word").agg(F.count(F.lit(1)).alias("n"))
    counted = each.join(counts, ["leaf", "at", "word"])
    # A list is as long as its line.
    lines = counted.groupBy("sig").agg(F.collect_list(F.struct("n", "at")).alias("places"), F.max("n").alias("top"))
    lines = lines.join(words, "sig")
    rare = F.sort_array(F.filter("places", lambda x: x["n"] < F.col("top")))
    # What rounding takes from whole numbers of words is given back.
    most = F.floor(F.size("words") * (1 - similarity) + 1e-9).cast("int")
    fields = F.array_sort(F.transform(F.slice(rare, F.lit(1), most), lambda x: x["at"]))
    lines = lines.withColumn("fields", fields)
    rest = F.filter("words", lambda _, i: ~F.array_contains("fields", i))
    return lines.select("sig", F.xxhash64(F.lit("template"), "leaf", "fields", rest).alias("template"))


def _templates(docs: DataFrame, id_col: str, text_col: str, depth: int, similarity: float) -> DataFrame:
    """(doc_id, line, size, template) of every line with a word, written once."""
    rows = _rows(docs, id_col, text_col)
    lines = _all_lines(rows, depth)
    # Fewer words than this have no room for a field.
    least = next((n for n in range(depth + 1, 1000) if int(n * (1 - similarity) + 1e-9) >= 1), 1000)
    several = lines.filter(F.col("size") >= least).groupBy("leaf").agg(F.min("sig").alias("a"), F.max("sig").alias("b"))
    several = stage(several.filter("a <> b").select("leaf"), "leaves")
    found = generalised(_words(rows, several, depth, least), depth, similarity)
    own = salted_join(lines, found.withColumnRenamed("sig", "own_sig"), "sig", "own_sig")
    return stage(own.select("doc_id", "line", "size", F.coalesce("template", "sig").alias("template")), "template_lines")


def _recurring(lines: DataFrame, least_docs: int, short_docs: int) -> DataFrame:
    """(template, docs, keeper) of the templates that recur."""
    once = lines.groupBy("template", "doc_id").agg(F.min("size").alias("size"))
    every = once.groupBy("template").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("keeper"), F.min("size").alias("size"))
    enough = F.when(F.col("size") < SHORT, max(short_docs, least_docs)).otherwise(least_docs)
    return stage(every.filter(F.col("docs") >= enough).select("template", "docs", "keeper"), "recurring")


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
              similarity: float = SIMILARITY, least_docs: int = LEAST_DOCS, short_docs: int = SHORT_DOCS) -> DataFrame:
    """(template, docs, keeper): the templates that recur, in how many documents,
    and the one that keeps them."""
    return _recurring(_templates(docs, id_col, text_col, depth, similarity), least_docs, short_docs)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                  similarity: float = SIMILARITY, least_docs: int = LEAST_DOCS, short_docs: int = SHORT_DOCS) -> DataFrame:
    """(doc_id, lines): sorted 0-based numbers of the lines to drop, for the
    documents that have any."""
    lines = _templates(docs, id_col, text_col, depth, similarity)
    again = _recurring(lines, least_docs, short_docs).select(F.col("template").alias("again"), "keeper")
    # A line that a third of the documents hold is one hot key here.
    met = stage(salted_join(lines, again, "template", "again", "inner").select("doc_id", "line", "template", "keeper"), "met_lines")
    own = met.filter("doc_id = keeper")
    first = own.groupBy("template").agg(F.min("line").alias("stays"))
    rest = own.join(first, "template").filter("line > stays").select("doc_id", "line")
    drop = met.filter("doc_id <> keeper").select("doc_id", "line").union(rest)
    return drop.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def without(text: Column, lines: Column) -> Column:
    """``text`` without the numbered lines."""
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains(lines, i.cast("long")))
    return F.when(lines.isNull(), text).otherwise(F.array_join(kept, "\n"))

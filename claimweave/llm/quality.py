"""Quality classifier: a factorisation machine.

A text is a sparse row: hashed words, weighted so that long texts don't weigh
more, structure statistics cut into steps, and metadata (the recorded length
and how it compares with the text's). The machine scores a linear part and all
pairwise interactions through ``RANK``-dimensional factors, in time linear in
the row's entries by the sum-of-squares identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

It is fitted on the driver by Adagrad, on at most about ``MOST_TRAINED``
labelled rows; scoring covers all texts, whole, one row at a time.

Defined cases: null and empty texts have no words and are scored by structure
and metadata; a null recorded length is a feature of its own; without rows of
both labels the score is the share of label 1 (0.5 without labels); labels that
are null train nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.textbatch import Texts, hash_spans, runs

#: Labelled rows that the machine is fitted on, about.
MOST_TRAINED = 12_000
WORD_BUCKETS = 1 << 13
RANK, EPOCHS, BATCH, RATE, RIDGE, SEED = 8, 12, 256, 0.1, 1e-3, 5
#: Length of a text's word entries; its statistics have length 2.
WORD_SCALE = 0.25
_STEPS = 12
_DIGIT, _UPPER, _LETTER = (np.zeros(256, bool) for _ in range(3))
_DIGIT[0x30:0x3A] = True
_UPPER[0x41:0x5B] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
STATISTICS = ("words", "upper", "digits", "symbols", "blanks", "word_length", "distinct_words", "repeats", "long_words",
              "line_length", "lines_ended", "distinct_lines", "bars", "marked_words")
METADATA = ("recorded_length", "length_ratio")
WIDTH = WORD_BUCKETS + (len(STATISTICS) + len(METADATA)) * _STEPS


def _per(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    return total / np.maximum(n, 1)


def statistics(t: Texts, h: np.ndarray) -> np.ndarray:
    """Structure of each text: shares from 0 to 1, and scaled logarithms (rows x STATISTICS)."""
    size = t.end - t.begin

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind)])
        return _per(total[t.end] - total[t.begin], size)

    words = t.counts()
    by = lambda values: np.bincount(t.doc, weights=values, minlength=t.n)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (t.doc[1:] == t.doc[:-1])])[:len(h)]
    key = np.unique(np.stack([t.doc.astype(np.uint64), h]), axis=1)[0].astype(np.int64)
    breaks = np.flatnonzero(t.raw == 10)
    begins = np.concatenate([[0], breaks[:-1] + 1])
    line_doc = np.searchsorted(t.end, begins, side="left")
    full = breaks > begins
    begins, stops, line_doc = begins[full], breaks[full], line_doc[full]
    lines = np.bincount(line_doc, minlength=t.n)
    ended = np.isin(t.raw[stops - 1], np.frombuffer(b".!?:\"'", np.uint8)) if len(stops) else np.zeros(0, bool)
    marks = np.stack([line_doc.astype(np.uint64), hash_spans(t.raw, begins, stops - begins)])
    distinct = np.unique(marks, axis=1)[0].astype(np.int64)
    last = t.raw[t.start + t.length - 1] if len(h) else np.zeros(0, np.uint8)
    marked = ~_LETTER[last] & ~_DIGIT[last] & ~np.isin(last, np.frombuffer(b".,", np.uint8))
    return np.stack([
        np.log1p(words) / 12, share(_UPPER[t.raw]), share(_DIGIT[t.raw]),
        share(~(_LETTER | _DIGIT | _BLANK)[t.raw]), share(_BLANK[t.raw]), np.minimum(_per(by(t.length), words) / 20, 1),
        _per(np.bincount(key, minlength=t.n), words), _per(by(same), words), _per(by(t.length > 15), words),
        np.log1p(_per(size, lines)) / 12, _per(np.bincount(line_doc, weights=ended, minlength=t.n), lines),
        _per(np.bincount(distinct, minlength=t.n), lines), share(t.raw == ord("|")), _per(by(marked), words)], axis=1)


def _metadata(t: Texts, chars: np.ndarray, known: np.ndarray) -> np.ndarray:
    lead = np.concatenate([[0], np.cumsum((t.raw & 0xC0) != 0x80)])
    actual = lead[t.end] - lead[t.begin]
    ratio = np.clip(chars / np.maximum(actual, 1), 0, 2) / 2
    return np.where(known[:, None], np.stack([np.log1p(np.maximum(chars, 0)) / 14, ratio], axis=1), np.nan)


def features(t: Texts, chars: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the entries of a run of texts, rows in order."""
    w = t.trimmed()
    pairs = np.unique(w.doc * np.int64(WORD_BUCKETS) + (w.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64))
    row, bucket = pairs // WORD_BUCKETS, pairs % WORD_BUCKETS
    value = WORD_SCALE / np.sqrt(np.bincount(row, minlength=t.n))[row] if len(row) else np.zeros(0)
    dense = np.concatenate([statistics(t, t.hashes()), _metadata(t, chars, known)], axis=1)
    # A missing number takes the last step of its feature.
    step = np.where(np.isnan(dense), _STEPS - 1, np.minimum(np.nan_to_num(np.sqrt(np.maximum(dense, 0))) * (_STEPS - 1), _STEPS - 2))
    step = step.astype(np.int64) + WORD_BUCKETS + np.arange(dense.shape[1]) * _STEPS
    rows = np.repeat(np.arange(t.n), dense.shape[1])
    order = np.argsort(np.concatenate([row, rows]), kind="stable")
    return (np.concatenate([row, rows])[order], np.concatenate([bucket, step.ravel()])[order],
            np.concatenate([value, np.full(len(rows), 1 / np.sqrt(dense.shape[1] / 4))])[order])


def _recorded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    known = np.asarray(column.is_valid())
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(float), known


def train(rows: DataFrame, text_col: str = "text", chars_col: str = "n_chars", label_col: str = "label") -> QualityModel:
    """Machine fitted on (label, text, recorded length) rows, about ``MOST_TRAINED`` of them."""
    own = rows.filter(F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("int").alias("label"), F.col(text_col).cast("binary").alias("text"),
        F.col(chars_col).cast("double").alias("chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, (chars, known) = batch.column(0).to_numpy(), _recorded(batch.column(2))
            for t in runs(batch.column(1)):
                row, feature, value = features(t, chars[t.rows], known[t.rows])
                cut = np.searchsorted(row, np.arange(1, t.n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label[t.rows]), pa.array(np.split(feature.astype(np.int32), cut), pa.list_(pa.int32())),
                     pa.array(np.split(value.astype(np.float32), cut), pa.list_(pa.float32()))], ["label", "feature", "value"])

    got = own.mapInArrow(run, "label int, feature array<int>, value array<float>").toArrow().combine_chunks()
    n = got.num_rows
    y = got["label"].to_numpy().astype(float)
    feature = [np.asarray(x.values) for x in got["feature"]]
    value = [np.asarray(x.values) for x in got["value"]]
    # An order of the rows that doesn't depend on how they arrive.
    order = sorted(range(n), key=lambda i: (feature[i].tobytes(), value[i].tobytes(), y[i]))
    model = QualityModel(0.0, np.zeros(WIDTH), np.zeros((WIDTH, RANK)))
    if not n or not 0 < y.sum() < n:
        model.bias = 0.0 if not n else 30.0 if y.all() else -30.0
        return model
    model.fit([feature[i] for i in order], [value[i] for i in order], y[order])
    return model


@dataclass
class QualityModel:
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """Log-odds of rows 0 to n, each with at least one entry, entries in row order."""
        begin = np.searchsorted(row, np.arange(n))
        linear = np.add.reduceat(self.weight[feature] * value, begin)
        vx = self.factor[feature] * value[:, None]
        total = np.add.reduceat(vx, begin, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), begin)
        return self.bias + linear + ((total * total).sum(axis=1) - squares) / 2

    def fit(self, feature: list[np.ndarray], value: list[np.ndarray], y: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.factor = rng.normal(0, 0.05, self.factor.shape)
        self.bias = float(np.log(y.mean() / (1 - y.mean())))
        seen_w, seen_v = np.full(WIDTH, 1e-6), np.full(self.factor.shape, 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for part in np.split(order, range(BATCH, len(order), BATCH)):
                f, x = np.concatenate([feature[i] for i in part]), np.concatenate([value[i] for i in part])
                row = np.repeat(np.arange(len(part)), [len(feature[i]) for i in part])
                begin = np.searchsorted(row, np.arange(len(part)))
                vx = self.factor[f] * x[:, None]
                total = np.add.reduceat(vx, begin, axis=0)
                p = 1 / (1 + np.exp(-np.clip(self.raw(row, f, x, len(part)), -30, 30)))
                error = (p - y[part])[row] / len(part)
                used, at = np.unique(f, return_inverse=True)
                gw = np.bincount(at, weights=error * x) + RIDGE / len(y) * self.weight[used]
                each = error[:, None] * x[:, None] * (total[row] - vx)
                gv = np.stack([np.bincount(at, weights=each[:, k]) for k in range(RANK)], axis=1)
                gv += RIDGE / len(y) * self.factor[used]
                seen_w[used] += gw * gw
                seen_v[used] += gv * gv
                self.weight[used] -= RATE * gw / np.sqrt(seen_w[used])
                self.factor[used] -= RATE / 4 * gv / np.sqrt(seen_v[used])
                self.bias -= RATE * float((p - y[part]).mean())

    def column(self, text: Column, chars: Column) -> Column:
        """The probability of label 1."""
        model = self

        @F.arrow_udf("double")
        def score(texts: pa.Array, recorded: pa.Array) -> pa.Array:
            out, (length, known) = np.zeros(len(texts)), _recorded(recorded)
            for t in runs(texts):
                row, feature, value = features(t, length[t.rows], known[t.rows])
                out[t.rows] = model.raw(row, feature, value, t.n)
            return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

        return score(text, chars.cast("double"))

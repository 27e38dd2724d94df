"""Toxic passages as maximum-scoring segments.

``train`` learns the log-odds of words between toxic and other labelled texts.
A word counts once for each pair of neighbours it occurs between, so copies of
one text don't make their words toxic. Counts are shrunk by Dirichlet priors:
a word's prior is that of its prefix (of ``PREFIXES`` letters) where several
words of toxic texts share it, so new forms of a known stem score too.

``ToxicityModel.column`` scans a text once: words score their log-odds less a
drift, and all maximal scoring segments are found in linear time (Ruzzo and
Tompa). A segment's score S is judged as an extreme value over the words of
clean texts: E = K n exp(-lambda S), lambda solving sum p exp(lambda s) = 1.
The evidence of a text, the sum of -log E over its segments below 1, and its best
segment's become a probability by a logistic fit of their logarithms on the
labelled texts, so one strong passage counts in a text of any length.

Defined cases: null and empty texts have no evidence and get the score of a
text without any; without toxic or without other labelled texts nothing is
learned and each score is the share of toxic labels (0 without labels); labels
that are null train nothing. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.textbatch import Texts, chain, hash_spans, runs
from claimweave.sources.sinks import stage

#: Words with fewer different neighbour pairs in toxic texts are not learned.
LEAST_CONTEXTS = 5
#: Letters (code points).
PREFIXES = (6, 5, 4)
#: Words of toxic texts that must share a prefix before it counts.
LEAST_FORMS = 4
PRIOR = 2.0
LEAST_Z = 3.0
DRIFT = 0.5
MOST_ODDS = 10.0
_STEP = 0.25
_ROUNDS = 200
_RIDGE = 0.1
PASSAGES = "score: double, evidence: double, passages: array<struct<begin: bigint, end: bigint, score: double>>"


def terms(t: Texts) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hashes of the words of trimmed texts, and of their prefixes (0: no longer than it)."""
    prefixes, letters = [], np.append(np.flatnonzero((t.buf & 0xC0) != 0x80), len(t.buf))
    first = np.searchsorted(letters, t.start)
    for n in PREFIXES:
        size = letters[np.minimum(first + n, len(letters) - 1)] - t.start
        h = hash_spans(t.buf, t.start, np.minimum(t.length, size)) ^ np.uint64(n)
        prefixes.append(np.where(t.length > size, h, np.uint64(0)))
    return t.hashes(), prefixes


def _contexts(t: Texts, h: np.ndarray) -> np.ndarray:
    before, after = np.roll(h, 1), np.roll(h, -1)
    before[np.diff(t.doc, prepend=-1) != 0] = 0
    after[np.diff(t.doc, append=-1) != 0] = 0
    return chain([h, before, after])


def _toxic_contexts(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in runs(batch.column(0)):
                t = t.trimmed()
                h, prefixes = terms(t)
                _, at = np.unique(_contexts(t, h), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[at].view(np.int64)) for x in (_contexts(t, h), h, *prefixes)], names)

    names = ["context", "word", *[f"p{n}" for n in PREFIXES]]
    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _clean_counts(texts: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int]:
    """Occurrences of the known terms in clean texts, and of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = np.zeros(len(known), np.int64), 0
        for batch in batches:
            for t in runs(batch.column(0)):
                t = t.trimmed()
                h, prefixes = terms(t)
                words += len(h)
                for x in (h, *prefixes):
                    at = _find(known, x)
                    total += np.bincount(at[at >= 0], minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], words))], ["k", "n"])

    got = texts.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    k, n = got["k"].to_numpy(), got["n"].to_numpy()
    out = np.zeros(len(known))
    out[k[k >= 0]] = n[k >= 0]
    return out, int(n[k < 0].sum())


def _find(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where each hash is among the sorted known ones; -1 elsewhere."""
    if not len(known):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, at, -1)


def train(texts: DataFrame, text_col: str = "text", label_col: str = "label") -> ToxicityModel:
    """Model of (label, text) rows. The driver holds the terms of the toxic ones, whose
    number the bound on labelled rows limits (``folds.MOST_LABELLED``)."""
    text = F.col(text_col).cast("binary").alias("text")
    rows = texts.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    toxic, clean = rows.filter(F.col(label_col) == 1).select(text), rows.filter(F.col(label_col) == 0).select(text)
    seen = stage(_toxic_contexts(toxic).distinct(), "toxic_contexts")
    n1 = seen.count()
    words = seen.groupBy(F.col("word").alias("term")).agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("forms"))
    parts = [words]
    for p in PREFIXES:
        forms = seen.filter(F.col(f"p{p}") != 0).groupBy(F.col(f"p{p}").alias("term"), "word").agg(F.count(F.lit(1)).alias("n"))
        parts.append(forms.groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))
                     .filter(F.col("forms") >= LEAST_FORMS))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    got = every.filter(F.col("n") >= LEAST_CONTEXTS).toArrow()
    known = got["term"].to_numpy().view(np.uint64)
    order = np.argsort(known, kind="stable")
    known, y1 = known[order], got["n"].to_numpy().astype(float)[order]
    y0, n0 = _clean_counts(clean, known)
    model = ToxicityModel(known, y1, y0, n1, n0)
    model.calibrate()
    model.fit(rows.select(F.col(label_col).cast("int").alias("label"), text))
    return model


@dataclass
class ToxicityModel:
    """Counts of the known terms in toxic (y1 of n1) and clean (y0 of n0) texts,
    the extreme-value constants and the logistic fit: its level, and the slopes of
    the logarithms of all passages' evidence and of the best one's."""

    known: np.ndarray
    y1: np.ndarray
    y0: np.ndarray
    n1: int
    n0: int
    decay: float = 0.0
    spread: float = 0.0
    slopes: tuple[float, float] = (0.0, 0.0)
    level: float = 0.0

    def _odds(self, y1: np.ndarray, y0: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Log-odds of counts with a Dirichlet prior of mean ``share``; 0 unless significant."""
        a, b = y1 + PRIOR * share, y0 + PRIOR * (1 - share)
        odds = np.log(a / self.n1) - np.log(b / self.n0)
        z = odds / np.sqrt(1 / a + 1 / np.maximum(b, 0.5))
        return np.where(z >= LEAST_Z, np.minimum(odds, MOST_ODDS), 0.0)

    def scores(self, t: Texts) -> np.ndarray:
        """Score of each word of trimmed texts."""
        h, prefixes = terms(t)
        if not len(self.known) or not self.n0:
            return np.full(len(h), -DRIFT)
        base = self.n1 / (self.n1 + self.n0)
        stem = np.full(len(h), -1)
        for p in reversed(prefixes):  # the longest known prefix decides
            at = _find(self.known, p)
            stem = np.where(at >= 0, at, stem)
        own = _find(self.known, h)
        some = np.flatnonzero((own >= 0) | (stem >= 0))
        own, stem = own[some], stem[some]
        share = np.where(stem >= 0, (self.y1[stem] + base) / (self.y1[stem] + self.y0[stem] + 1), base)
        share = np.where(own >= 0, share, base)
        term = np.where(own >= 0, own, stem)
        out = np.full(len(h), -DRIFT)
        out[some] += self._odds(self.y1[term], self.y0[term], share)
        return out

    def calibrate(self) -> None:
        """Extreme-value constants for the scores of words in clean texts."""
        if not len(self.known) or not self.n0:
            return
        base = self.n1 / (self.n1 + self.n0)
        score = self._odds(self.y1, self.y0, np.full(len(self.known), base)) - DRIFT
        up = score > 0
        if not up.any():
            return
        p = (self.y0[up] + PRIOR * (1 - base)) / (self.n0 + PRIOR)
        s, rest = score[up], max(0.0, 1 - p.sum())
        total = lambda x: (p * np.exp(x * s)).sum() + rest * np.exp(-x * DRIFT) - 1
        lo, hi = 0.0, 1.0
        while total(hi) < 0:
            hi *= 2
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if total(mid) < 0 else (lo, mid)
        self.decay, self.spread = hi, float((p * np.exp(hi * s)).sum())

    def segments(self, t: Texts) -> Iterator[tuple[int, float, list[tuple[int, int, float]]]]:
        """(text, evidence, significant segments) of the trimmed texts that have any evidence."""
        if not self.decay:
            return
        score, cut = self.scores(t), t.firsts()
        up = np.flatnonzero(score > 0)
        for d in np.unique(t.doc[up]):
            lo, hi = cut[d], cut[d + 1]
            at = up[np.searchsorted(up, lo):np.searchsorted(up, hi)]
            worst = np.log(self.spread * (hi - lo))
            found, evidence = [], 0.0
            for a, b, s in maximal_segments(at, score):
                e = self.decay * s - worst
                if e > 0:
                    evidence += e
                    found.append((a, b, e))
            if evidence:
                yield int(d), float(evidence), found

    def fit(self, rows: DataFrame) -> None:
        """Logistic fit of the labels on the evidence, from a histogram of both: a
        step of the logarithm of all passages' evidence, and one of the best's."""
        model = self

        @F.arrow_udf("struct<sum: int, best: int>")
        def steps(texts: pa.Array) -> pa.Array:
            out = np.zeros((2, len(texts)), np.int32)
            for t in runs(texts):
                t = t.trimmed()
                for d, evidence, found in model.segments(t):
                    out[:, t.rows[d]] = np.ceil(_logs(evidence, found) / _STEP)
            return pa.StructArray.from_arrays([pa.array(out[0]), pa.array(out[1])], ["sum", "best"])

        got = rows.groupBy("label", steps("text").alias("step")).count().collect()
        x = np.array([[1.0, r["step"]["sum"] * _STEP, r["step"]["best"] * _STEP] for r in got]).reshape(-1, 3)
        y, w = np.array([r["label"] for r in got], float), np.array([r["count"] for r in got], float)
        total = w.sum()
        if not total or not 0 < (w * y).sum() < total:
            self.slopes, self.level = (0.0, 0.0), 50.0 if total and y.all() else -50.0
            return
        beta = np.array([np.log((w * y).sum() / (w * (1 - y)).sum()), 0.0, 0.0])
        for _ in range(_ROUNDS):
            q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            g = x.T @ (w * (y - q)) - _RIDGE * beta
            m = (x * (w * q * (1 - q))[:, None]).T @ x + _RIDGE * np.eye(3)
            step = np.clip(np.linalg.solve(m, g), -2, 2)
            beta += step
            if np.abs(step).max() < 1e-9:
                break
        self.level, self.slopes = float(beta[0]), (float(beta[1]), float(beta[2]))

    def column(self, text: Column) -> Column:
        """Struct (score, evidence, passages): the probability of the toxic label,
        and the byte ranges of all significant passages with their -log E."""
        model = self

        @F.arrow_udf(PASSAGES)
        def score(texts: pa.Array) -> pa.Array:
            evidence, logs, passages = np.zeros(len(texts)), np.zeros((len(texts), 2)), [[] for _ in range(len(texts))]
            for t in runs(texts):
                t = t.trimmed()
                for d, e, found in model.segments(t):
                    evidence[t.rows[d]], logs[t.rows[d]] = e, _logs(e, found)
                    begin = t.begin[d]
                    passages[t.rows[d]] = [{"begin": int(t.start[a] - begin), "end": int(t.start[b] + t.length[b] - begin),
                                            "score": float(s)} for a, b, s in found]
            p = 1 / (1 + np.exp(-np.clip(model.level + logs @ np.array(model.slopes), -30, 30)))
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            return pa.StructArray.from_arrays([pa.array(p), pa.array(evidence), pa.array(passages, kind)],
                                              ["score", "evidence", "passages"])

        return score(text)


def _logs(evidence: float, found: list[tuple[int, int, float]]) -> np.ndarray:
    return np.log1p([evidence, max(e for _, _, e in found)])


def maximal_segments(up: np.ndarray, score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in one pass over
    the words ``up`` of positive score; the words between score ``-DRIFT`` each."""
    stack: list[list] = []  # first, last, sum before it, sum with it
    total, before = 0.0, None
    for k in map(int, up):
        if before is not None:
            total -= DRIFT * (k - before - 1)
        left = total
        total += float(score[k])
        before = k
        segment = [k, k, left, total]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= segment[2]:
                j -= 1
            if j < 0 or stack[j][3] >= segment[3]:
                stack.append(segment)
                break
            segment = [stack[j][0], segment[1], stack[j][2], segment[3]]
            del stack[j:]
    return [(a, b, right - left) for a, b, left, right in stack]

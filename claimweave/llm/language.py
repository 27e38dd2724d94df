"""Language identification by multilingual mixture inference.

``train`` counts hashed byte 4-grams of the letters of each language over the
labelled texts. ``LanguageModel.column`` scores a text column: the words of a
text are drawn from a mixture of languages with the n-gram likelihoods as
component densities, expectation-maximisation estimates the proportions, and
of the sets of the 1, 2, ... most frequent languages the one with the largest
penalised likelihood is taken (each further language costs ``penalty *
log(words)``). All learned languages can be in it, with any share of the words.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if no labelled text has a letter. Rows with a null label or
text train nothing. Repeated rows count as often as they occur. Texts are read
whole, long ones in pieces of which only the words' likelihoods are kept; ties between languages go to the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.textbatch import Texts, pieces

UNDETERMINED = "und"
#: Buckets of hashed n-grams (a power of two); the model holds languages x buckets counts.
BUCKET_BITS = 16
SMOOTHING = 0.5
ROUNDS = 10
PENALTY = 2.0
_WORDS_AT_ONCE = 1 << 18

_KIND = np.zeros(256, bool)
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _grams(t: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of letter bytes, bucket of the 4-gram that ends there)."""
    letter = _KIND[t.buf]
    b = np.where(letter, t.buf, np.uint8(0)).astype(np.uint32)
    back1 = np.concatenate([[0], b[:-1]]).astype(np.uint32)
    back2 = np.concatenate([[0], back1[:-1]]).astype(np.uint32)
    back3 = np.concatenate([[0], back2[:-1]]).astype(np.uint32)
    back2[back1 == 0] = 0
    back3[back2 == 0] = 0
    at = np.flatnonzero(letter)
    g = (b | back1 << np.uint32(8) | back2 << np.uint32(16) | back3 << np.uint32(24))[at]
    with np.errstate(over="ignore"):
        g = (g ^ g >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        g = (g ^ g >> np.uint32(12)) * np.uint32(0x297A2D39)
    return at, g >> np.uint32(32 - bits)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          bucket_bits: int = BUCKET_BITS) -> LanguageModel:
    """Model of the languages in ``lang_col`` from all rows with a label and a text.

    Counts are summed inside each task and then by Spark; the driver receives
    at most languages x buckets counts, whatever the number of texts.
    """
    size = 1 << bucket_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for t, _, _ in pieces(batch.column(0)):
                at, g = _grams(t, bucket_bits)
                own = [langs[r] for r in t.rows]
                names = sorted(set(own))
                code = np.array([names.index(x) for x in own])[np.searchsorted(t.end, at, side="right")]
                n = np.bincount(code * size + g, minlength=len(names) * size).reshape(-1, size)
                for k, name in enumerate(names):
                    total[name] = total.get(name, 0) + n[k]
        for name, n in total.items():
            at = np.flatnonzero(n)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])],
                                                 ["lang", "bucket", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("binary").alias("text"), F.col(lang_col).alias("lang"))
    counts = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts["lang"].to_pylist()))
    table = np.zeros((size, len(names)))
    if names:
        code = np.searchsorted(np.array(names, object), np.array(counts["lang"].to_pylist(), object))
        table[counts["bucket"].to_numpy(), code] = counts["n"].to_numpy()
    logs = np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * size)) if names else table
    return LanguageModel(names, logs.astype(np.float32), bucket_bits)


@dataclass
class LanguageModel:
    names: list[str]
    logs: np.ndarray
    bucket_bits: int

    def column(self, text: Column, penalty: float = PENALTY) -> Column:
        """Struct (lang, score, languages): the main language, its share of the
        words, and ``name:share`` of each language of the chosen set."""
        model = self

        @F.arrow_udf("lang string, score double, languages string")
        def identify(texts: pa.Array) -> pa.Array:
            out = [(UNDETERMINED, 0.0, "")] * len(texts)
            held: list[tuple[np.ndarray, bool]] = []
            for t, opens, closes in pieces(texts):
                logs, doc = model.word_logs(t)
                lettered = _lettered(t)
                if not (opens and closes):
                    # Of a long text only the words' likelihoods are kept together.
                    held = [*([] if opens else held), (logs, bool(lettered.any()))]
                    if not closes:
                        continue
                    logs, lettered = np.concatenate([x for x, _ in held]), np.array([any(x for _, x in held)])
                    doc, held = np.zeros(len(logs), np.int64), []
                for row, found in zip(t.rows, model.infer(logs, doc, lettered, penalty), strict=True):
                    out[row] = found
            lang, score, languages = zip(*out, strict=True) if out else ((), (), ())
            return pa.StructArray.from_arrays(
                [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(languages, pa.string())],
                ["lang", "score", "languages"])

        return identify(text)

    def word_logs(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihoods of the words that hold letters, under each language; text of each)."""
        at, g = _grams(t, self.bucket_bits)
        if not self.names or not len(at):
            return np.zeros((0, len(self.names)), np.float32), np.zeros(0, np.int64)
        word = np.searchsorted(t.start, at, side="right") - 1
        first = np.flatnonzero(np.diff(word, prepend=-1))
        return np.add.reduceat(self.logs[g], first, axis=0), t.doc[word[first]]

    def infer(self, logs: np.ndarray, doc: np.ndarray, lettered: np.ndarray, penalty: float) -> list[tuple[str, float, str]]:
        """(lang, score, languages) of each text, from its words' log-likelihoods;
        texts that are not ``lettered`` are undetermined."""
        found = [(UNDETERMINED, 0.0, "")] * len(lettered)
        if not len(logs):
            return found
        best = logs.max(axis=1, keepdims=True)
        p = np.exp(np.maximum(logs - best, -30.0))
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        own, n = doc[begin], np.diff(np.append(begin, len(doc)))
        at_word = np.repeat(np.arange(len(own)), n)
        share = _em(p, begin, at_word, n, np.full((len(own), len(self.names)), 1 / len(self.names), np.float32))
        single = np.add.reduceat(logs - best, begin, axis=0)
        main = single.argmax(axis=1)
        rank = np.argsort(-share, axis=1, kind="stable")
        value = single.max(axis=1).astype(np.float64)
        chosen = np.zeros_like(share)
        chosen[np.arange(len(own)), main] = 1
        for k in range(2, len(self.names) + 1):
            # No likelihood is above 0 here, so where the cost alone is no gain larger sets can't win.
            try_docs = np.flatnonzero(value < -penalty * (k - 1) * np.log(n))
            if not len(try_docs):
                break
            allowed = np.zeros((len(try_docs), len(self.names)), np.float32)
            np.put_along_axis(allowed, rank[try_docs, :k], 1, axis=1)
            some = np.isin(at_word, try_docs)
            nk = n[try_docs]
            bk = np.concatenate([[0], np.cumsum(nk)[:-1]])
            wk = np.repeat(np.arange(len(try_docs)), nk)
            prior = share[try_docs] * allowed
            fit = _em(p[some], bk, wk, nk, prior / prior.sum(axis=1, keepdims=True))
            like = np.add.reduceat(np.log(np.maximum((p[some] * fit[wk]).sum(axis=1), 1e-30)), bk)
            gain = like - penalty * (k - 1) * np.log(nk)
            better = gain > value[try_docs]
            value[try_docs[better]] = gain[better]
            chosen[try_docs[better]] = fit[better]
        for i, d in enumerate(own):
            order = [j for j in np.argsort(-chosen[i], kind="stable") if chosen[i, j] > 0]
            found[d] = (self.names[order[0]], float(min(1.0, chosen[i, order[0]])),
                        ",".join(f"{self.names[j]}:{chosen[i, j]:.3f}" for j in order))
        return [x if ok else (UNDETERMINED, 0.0, "") for x, ok in zip(found, lettered, strict=True)]


def _lettered(t: Texts) -> np.ndarray:
    """Whether each text has a letter; bytes beyond ASCII may be none."""
    out = np.zeros(t.n, bool)
    for d in range(t.n):
        raw = t.buf[t.begin[d]:t.end[d]]
        ascii_letter = _KIND[raw] & (raw < 0x80)
        out[d] = ascii_letter.any() or (raw.max(initial=0) >= 0x80 and any(
            c.isalpha() for c in raw.tobytes().decode("utf-8", "ignore")))
    return out


def _em(p: np.ndarray, begin: np.ndarray, doc: np.ndarray, n: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Proportions of each text's words, which start at ``begin``, after ``ROUNDS``
    rounds of expectation-maximisation; many words are taken in slices."""
    for _ in range(ROUNDS):
        total = np.zeros(share.shape)
        for lo in range(0, len(p), _WORDS_AT_ONCE):
            own = doc[lo:lo + _WORDS_AT_ONCE]
            r = p[lo:lo + _WORDS_AT_ONCE] * share[own]
            r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-30)
            first = begin if len(own) == len(p) else np.flatnonzero(np.diff(own, prepend=-1))
            total[own[first]] += np.add.reduceat(r, first, axis=0)
        share = (total / n[:, None]).astype(np.float32)
    return share

"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Words are lower-cased (A-Z) runs without ASCII white space; each text ends in one
end token. Counts of all words of all training texts are gathered first. The
``WORDS`` most frequent words are classes of their own, the others share
``ENDINGS`` classes by their last three bytes, and the end token is one more. The
model predicts the next class from the ``CONTEXT`` classes before it: the
predicted vector is the sum of their vectors, each weighted by position, and a
class scores its own vector's product with it plus a bias. Within a shared class,
words follow their smoothed counts, with one place for a word never met. So the
probabilities of the next token add up to 1.

Training is numpy inside the tasks: Adagrad on the noise-contrastive objective,
noise drawn from the class frequencies. Texts are read twice, for the counts and to
write each one's sequence of classes, which training and scoring read. The texts are
dealt into ``ROUNDS`` parts; in each round every task goes on from the common model over its texts of that
part, and the models are averaged by their tokens. So each text is used once,
whatever the corpus' size, and the driver receives a few models. Scoring uses the
exact normalisation over all classes. The score of a class is a sum over the
positions, so its exponential is a product of entries of one table a position,
made once a task; a token costs products and no exponentials.

Counts of at most ``COUNTED`` of the most frequent words travel with the tasks;
all other words of a text are joined with the counts by their hash and ending.
Words are known by 64-bit hashes: with V words, about V^2 / 2^65 pairs of them
are taken for one.

Defined cases: a null text is empty, and an empty or blank one is its end token;
long texts are worked on in pieces that carry their context; repeated rows and
rows with a null id are scored each; without training texts every class is as
likely as another. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.gather import summed
from claimweave.llm.textbatch import Texts, mix, pieces
from claimweave.sources.sinks import stage

WORDS, ENDINGS = 255, 256
SMOOTHING = 0.1
CONTEXT, WIDTH, ROUNDS = 4, 16, 3
BATCH, NOISE, RATE, SEED = 2048, 64, 0.2, 3
#: Words whose counts travel with the tasks (16 bytes each), at most.
COUNTED = 1 << 18
_END_BUCKET = -1
#: So many rows of all classes' scores stay in a core's cache.
_ROWS_AT_ONCE = 512
_TOKENS_AT_ONCE = 1 << 14
#: Products of exponentials up to this, and their sum over all classes, fit float32.
_REACH = 75
_FIT_AT_ONCE = 1 << 18
_EMIT = 1 << 20
_STEPS = 64
_f4 = np.float32
_LEAD = np.uint64(64 - 18)


def endings(t: Texts) -> np.ndarray:
    """The shared class (0 to ENDINGS) of each word."""
    last = t.start + t.length - 1
    code = np.ones(len(last), np.uint64)
    for k in range(3):
        code = code << np.uint64(8) | np.where(t.length > k, t.buf[np.maximum(last - k, 0)], 0).astype(np.uint64)
    return (mix(code) % np.uint64(ENDINGS)).astype(np.int64)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(h, ending, n) of all words and of the end token, written once."""

    def summed_up(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, ending, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(h)
        h, ending, n = h[order], ending[order], n[order]
        # Words with one hash but different endings may stay in several rows each, which are added up below.
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (ending[1:] != ending[:-1])))
        return h[first], ending[first], np.add.reduceat(n, first)

    def batch(held) -> pa.RecordBatch:
        h, ending, n = summed_up(held)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n)],
                                          ["h", "ending", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts = [], 0, 0
        for b in batches:
            for t, _, closes in pieces(b.column(0)):
                texts += t.n * closes
                h = t.hashes()
                if len(h):
                    own = summed_up([(h, endings(t), np.ones(len(h), np.int64))])
                    held.append(own)
                    size += len(own[0])
                if size > _EMIT:
                    yield batch(held)
                    held, size = [], 0
        if texts:
            held.append((np.zeros(1, np.uint64), np.array([_END_BUCKET]), np.array([texts])))
        if held:
            yield batch(held)

    found = docs.select(F.col("text").cast("binary")).mapInArrow(run, "h long, ending int, n long")
    return stage(found.groupBy("h", "ending").agg(F.sum("n").alias("n")), "word_counts")


@dataclass
class Vocabulary:
    """Counts over the training tokens. ``counted`` are hashes of words (sorted)
    with their counts ``n`` and classes; all words with a count of ``least`` or
    more are among them. ``rest`` is the log10 of what a word's smoothed count is
    divided by in each shared class."""

    tokens: int
    distinct: int
    ends: int
    least: int
    counted: np.ndarray
    ending: np.ndarray
    n: np.ndarray
    cls: np.ndarray
    frequency: np.ndarray
    rest: np.ndarray

    def __post_init__(self):
        self.begin = np.searchsorted(self.counted >> _LEAD, np.arange((1 << 64 - int(_LEAD)) + 1, dtype=np.uint64))

    @property
    def words(self) -> int:
        return len(self.frequency) - ENDINGS - 1

    @property
    def end(self) -> int:
        return len(self.frequency) - 1

    def find(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, classes) of words; the count is -1 of one that is not ``counted``."""
        n, cls = np.full(len(h), -1), self.words + ending
        # Hashes are spread evenly, so their leading bits nearly give the place.
        lead = (h >> _LEAD).astype(np.int64)
        at, stop = self.begin[lead], self.begin[lead + 1]
        left = np.flatnonzero(at < stop)
        while len(left):
            i = at[left]
            own = self.counted[i] == h[left]
            same = left[own]
            same, i = same[self.ending[i[own]] == ending[same]], i[own][self.ending[i[own]] == ending[same]]
            n[same], cls[same] = self.n[i], self.cls[i]
            left = left[~own]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return n, cls


def _vocabulary(counts: DataFrame, words: int, counted: int) -> Vocabulary:
    # Counts by step of their logarithm: the words above some step are few enough.
    step = F.floor(F.log2("n") * _STEPS).cast("int").alias("step")
    steps = counts.groupBy(step).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()
    least, met = 1 << 62, 0
    for s in sorted(steps, reverse=True):
        if met + s["words"] > counted:
            break
        met, least = met + s["words"], s["least"]
    classes = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toArrow()
    total, distinct = np.zeros((2, ENDINGS + 1), np.int64)  # the last place is the end token's
    total[classes["ending"].to_numpy()], distinct[classes["ending"].to_numpy()] = classes["n"].to_numpy(), classes["words"].to_numpy()
    top = counts.filter((F.col("n") >= least) & (F.col("ending") >= 0)).toArrow()
    h, ending, n = top["h"].to_numpy().view(np.uint64), top["ending"].to_numpy().astype(np.int64), top["n"].to_numpy()
    order = np.lexsort((ending, h))
    # One of two words with one hash but different endings is left to the join.
    order = order[np.append(True, h[order][1:] != h[order][:-1])] if len(h) else order
    h, ending, n = h[order], ending[order], n[order]
    own = np.lexsort((h, -n))[:words]
    frequency = np.zeros(len(own) + ENDINGS + 1)
    frequency[:len(own)] = n[own]
    shared, kinds = total[:ENDINGS].copy(), distinct[:ENDINGS].copy()
    np.subtract.at(shared, ending[own], n[own])
    np.subtract.at(kinds, ending[own], 1)
    frequency[len(own):] = np.append(shared, total[ENDINGS])
    cls = len(own) + ending
    cls[own] = np.arange(len(own))
    rest = np.log10(shared + SMOOTHING * (kinds + 1))
    return Vocabulary(int(total.sum()), int(distinct.sum()), int(total[ENDINGS]), int(least), h, ending, n, cls, frequency, rest)


def layout(cls: np.ndarray, counts: np.ndarray, end: int, closes: bool, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes of each text behind the CONTEXT classes before it, where each
    text's begin): ``before`` are end tokens, or what came before a piece."""
    size = counts + CONTEXT + int(closes)
    begin = np.cumsum(size) - size
    flat = np.full(size.sum(), end, np.int16)
    flat[:CONTEXT] = before
    flat[np.arange(len(cls)) + np.repeat(CONTEXT + begin - np.cumsum(counts) + counts, counts)] = cls
    return flat, np.append(begin, len(flat))


def tokens_of(flat: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the tokens, text of each) in what :func:`layout` gives."""
    size = np.diff(begin) - CONTEXT
    doc = np.repeat(np.arange(len(size)), size)
    return np.arange(len(doc)) + CONTEXT * (doc + 1), doc


def contexts(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The CONTEXT classes before each place, nearest first."""
    return np.stack([flat[at - j] for j in range(1, CONTEXT + 1)])


class LogBilinear:
    """Vectors of classes as context and as target, weights of positions, biases,
    and the squared gradients of each."""

    def __init__(self, classes: int, flat: np.ndarray | None = None, frequency: np.ndarray | None = None):
        shapes = [(classes, WIDTH), (classes, WIDTH), (CONTEXT, WIDTH), (classes,)]
        if flat is None:
            rng = np.random.default_rng(SEED)
            bias = np.log((frequency + SMOOTHING) / (frequency + SMOOTHING).sum())
            start = [rng.normal(0, 0.1, shapes[0]), rng.normal(0, 0.1, shapes[1]), np.full(shapes[2], 0.5), bias]
            self.arrays = [x.astype(_f4) for x in start] + [np.full(s, 1e-3, _f4) for s in shapes]
        else:
            cut = np.split(np.asarray(flat), np.cumsum([np.prod(s) for s in shapes * 2])[:-1])
            self.arrays = [x.reshape(s).astype(_f4) for x, s in zip(cut, shapes * 2, strict=True)]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays]).astype(np.float64)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        r, _, position, _ = self.arrays[:4]
        return sum(r[c] * p for c, p in zip(context, position, strict=True))

    def log_softmax(self, context: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of all classes after each context."""
        _, q, _, bias = self.arrays[:4]
        z = self.predicted(context) @ q.T
        z += bias
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return z

    def tables(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(exponentials, reach) by position: a row for each class met there, of the
        exponentials of what it adds to each class' score (the bias is in the first),
        and the largest exponent of the row. A shift of a row changes no probability,
        so its exponents are put evenly about 0."""
        r, q, position, bias = self.arrays[:4]
        exponentials, reach = [], []
        for j, p in enumerate(position):
            z = (r * p) @ q.T
            if j == 0:
                z += bias
            z -= (z.max(axis=1, keepdims=True) + z.min(axis=1, keepdims=True)) / 2
            reach.append(z.max(axis=1))
            with np.errstate(over="ignore"):  # such rows are beyond reach
                exponentials.append(np.exp(z, out=z))
        return exponentials, reach

    def log10_of(self, flat: np.ndarray, at: np.ndarray, tables: tuple[list[np.ndarray], list[np.ndarray]] | None = None) -> np.ndarray:
        """log10 of the probability of each class of ``flat`` at ``at`` after those before
        it, by the ``tables`` of this model."""
        exponentials, reach = tables or self.tables()
        out = np.empty(len(at))
        for lo in range(0, len(at), _TOKENS_AT_ONCE):
            own = at[lo:lo + _TOKENS_AT_ONCE]
            context, target = contexts(flat, own).astype(np.intp), flat[own]
            if sum(far[c] for far, c in zip(reach, context, strict=True)).max() < _REACH:
                mine = np.prod([table[c, target] for table, c in zip(exponentials, context, strict=True)], axis=0, dtype=np.float64)
                out[lo:lo + len(own)] = np.log(mine / _totals(exponentials, context))
            else:
                for k in range(0, len(own), _ROWS_AT_ONCE):
                    z = self.log_softmax(context[:, k:k + _ROWS_AT_ONCE])
                    out[lo + k:lo + k + len(z)] = z[np.arange(len(z)), target[k:k + len(z)]]
        return out / np.log(10)

    def gradients(self, seq: np.ndarray, context: np.ndarray, noise: np.ndarray, log_noise: np.ndarray):
        """The noise-contrastive objective (summed over tokens, which share the
        noise) and its gradients: (rows, values) of the context vectors, of the
        target vectors with the bias as last column, and of the positions."""
        r, q, position, bias = self.arrays[:4]
        vectors = r.take(context, axis=0)
        predicted = (vectors * position[:, None]).sum(axis=0)
        target, drawn_target, shift = q.take(seq, axis=0), q[noise], bias - log_noise
        met = np.einsum("nd,nd->n", predicted, target) + shift[seq]
        drawn = predicted @ drawn_target.T + shift[noise]
        up = 1 / (1 + np.exp(met))              # 1 - sigmoid
        down = np.exp(-drawn)
        down += 1
        np.divide(-1, down, out=down)           # - sigmoid
        back = up[:, None] * target + down @ drawn_target
        to_target = np.concatenate([np.concatenate([up[:, None] * predicted, down.T @ predicted]),
                                    np.concatenate([up, down.sum(axis=0)])[:, None]], axis=1)
        to_position = np.einsum("cnd,nd->cd", vectors, back)
        return (lambda: -np.logaddexp(0, -met).sum() - np.logaddexp(0, drawn).sum(),
                (context.ravel(), (back * position[:, None]).reshape(-1, r.shape[1])),
                (np.concatenate([seq, noise]), to_target), to_position)

    def step(self, seq: np.ndarray, context: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
        _, to_context, to_target, to_position = self.gradients(seq, context, noise, log_noise)
        own, total = _by_row(*to_context)
        self._move(0, own, total)
        own, total = _by_row(*to_target)
        self._move(1, own, total[:, :-1])
        self._move(3, own, total[:, -1])
        self._move(2, slice(None), to_position)

    def _move(self, k: int, rows, g: np.ndarray) -> None:
        seen = self.arrays[4 + k][rows] + g * g
        self.arrays[4 + k][rows] = seen
        self.arrays[k][rows] += RATE * g / np.sqrt(seen)

    def fit(self, flat: np.ndarray, at: np.ndarray, frequency: np.ndarray, rng: np.random.Generator) -> None:
        """One step for each ``BATCH`` of the tokens of ``flat`` at ``at``, in random order."""
        share = (frequency + SMOOTHING) / (frequency + SMOOTHING).sum()
        log_noise, ladder = np.log(NOISE * share).astype(_f4), np.cumsum(share)
        at = rng.permutation(at)
        for lo in range(0, len(at), BATCH):
            own = at[lo:lo + BATCH]
            noise = np.minimum(np.searchsorted(ladder, rng.random(NOISE)), len(share) - 1).astype(np.int16)
            self.step(flat[own], contexts(flat, own), noise, log_noise)


def _totals(tables: list[np.ndarray], context: np.ndarray) -> np.ndarray:
    """The sum over all classes of the products of the tables' rows for each context."""
    total, (product, factor) = np.empty(context.shape[1], _f4), np.empty((2, _ROWS_AT_ONCE, tables[0].shape[1]), _f4)
    for lo in range(0, len(total), _ROWS_AT_ONCE):
        first, *between, last = zip(tables, context[:, lo:lo + _ROWS_AT_ONCE], strict=True)
        x, y = product[:len(first[1])], factor[:len(first[1])]
        first[0].take(first[1], axis=0, out=x, mode="clip")
        for table, c in between:
            x *= table.take(c, axis=0, out=y, mode="clip")
        last[0].take(last[1], axis=0, out=y, mode="clip")
        np.einsum("nd,nd->n", x, y, out=total[lo:lo + len(x)])
    return total


def _by_row(rows: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, sums of their values)."""
    order = np.argsort(rows, kind="stable")
    at = rows[order]
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], np.add.reduceat(g.take(order, axis=0), first, axis=0)


def _sequences(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each piece of each row's text (columns id, text, learn), written once: its
    classes, sums over the words that are counted, and the words that are not."""
    kind = docs.schema["id"].dataType.simpleString()
    end_log, end_known = float(np.log10(vocabulary.ends + SMOOTHING)), int(vocabulary.ends > 0)
    outside = np.full(CONTEXT, vocabulary.end, np.int16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = outside
        for batch in batches:
            for t, opens, closes in pieces(batch.column(3)):
                h, ending, doc, counts = t.hashes(), endings(t), t.doc, t.counts()
                n, cls = vocabulary.find(h, ending)
                flat, begin = layout(cls, counts, vocabulary.end, closes, outside if opens else before)
                before = flat[-CONTEXT:]
                by = lambda values, doc=doc, t=t: np.bincount(doc, weights=values, minlength=t.n).astype(np.float64)
                met = n >= 0
                log = np.where(met, np.log10(np.maximum(n, 0) + SMOOTHING), 0.0)
                # Words left to the join get their place in a shared class there.
                within = by(np.where(met & (cls >= vocabulary.words), log - vocabulary.rest[ending], 0.0))
                rare = np.flatnonzero(~met)
                rare = rare[np.lexsort((ending[rare], h[rare], doc[rare]))]
                d, a, e = doc[rare], h[rare], ending[rare]
                first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (a[1:] != a[:-1]) | (e[1:] != e[:-1]))[:len(d)])
                times = np.diff(np.append(first, len(d)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(d[first], np.arange(t.n + 1)), pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(a[first].view(np.int64)), pa.array(e[first].astype(np.int32)), pa.array(times, pa.int64())],
                        ["h", "ending", "times"]))
                classes = pa.Array.from_buffers(pa.binary(), t.n, [None, pa.py_buffer((2 * begin).astype(np.int32)), pa.py_buffer(flat)])
                rows = pa.array(t.rows)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(rows) for k in range(3)], pa.array(counts + int(closes)),
                     pa.array(by(met).astype(np.int64) + int(closes) * end_known), pa.array(by(log) + int(closes) * end_log),
                     pa.array(within), lists, classes],
                    ["row", "id", "learn", "n_tokens", "n_known", "words", "within", "rare", "classes"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "id", "learn", F.col("text").cast("binary").alias("text"))
    return stage(rows.mapInArrow(run, f"row long, id {kind}, learn boolean, n_tokens long, n_known long, words double, within double, "
                                      "rare array<struct<h:long,ending:int,times:long>>, classes binary"), "class_sequences")


def _laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of a batch's pieces and where each begins."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.int16)[offsets[0] // 2:offsets[-1] // 2] if data else np.zeros(0, np.int16), (offsets - offsets[0]) // 2


def _averaged(sequences: DataFrame, vocabulary: Vocabulary, model: LogBilinear, seed: int) -> LogBilinear:
    """The mean of the tasks' models after their texts, weighted by tokens."""
    start, classes = model.flat(), len(vocabulary.frequency)

    def task(batches: Iterable[pa.RecordBatch]) -> np.ndarray | None:
        own, tokens, rng = LogBilinear(classes, start), 0, np.random.default_rng([SEED, seed])
        for batch in batches:
            flat, begin = _laid_out(batch.column(0))
            at, _ = tokens_of(flat, begin)
            for lo in range(0, len(at), _FIT_AT_ONCE):
                own.fit(flat, at[lo:lo + _FIT_AT_ONCE], vocabulary.frequency, rng)
            tokens += len(at)
        return np.append(own.flat() * tokens, tokens) if tokens else None

    total = summed(sequences.select("classes"), task)
    return model if total is None else LogBilinear(classes, total[:-1] / total[-1])


def _fitted(sequences: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    model = LogBilinear(len(vocabulary.frequency), frequency=vocabulary.frequency)
    part = F.pmod(F.xxhash64("row"), F.lit(ROUNDS))
    for k in range(ROUNDS):
        model = _averaged(sequences.filter(F.col("learn") & (part == k)), vocabulary, model, k)
    return model


@dataclass
class NeuralLM:
    vocabulary: Vocabulary
    model: LogBilinear
    counts: DataFrame

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_tokens, n_known, base_score, score) of each row: tokens, those met
        in training, and the log10 probabilities of the text by smoothed word
        frequencies and by the model."""
        return self._scored(_sequences(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                                   F.lit(False).alias("learn")), self.vocabulary))

    def _scored(self, sequences: DataFrame) -> DataFrame:
        vocabulary, model = self.vocabulary, self.model
        kind = sequences.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = model.tables()
            for batch in batches:
                flat, begin = _laid_out(batch.column(6))
                at, doc = tokens_of(flat, begin)
                own = np.bincount(doc, weights=model.log10_of(flat, at, tables), minlength=batch.num_rows).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(5)],
                                                  pa.array(own + batch.column(5).to_numpy())],
                                                 ["row", "id", "n_tokens", "n_known", "words", "scored"])

        sums = sequences.select("row", "id", "n_tokens", "n_known", "words", "within", "classes").mapInArrow(
            run, f"row long, id {kind}, n_tokens long, n_known long, words double, scored double")
        rare = sequences.select("row", F.explode("rare").alias("r")).select("row", "r.*")
        left = rare.join(self.counts.filter("ending >= 0"), ["h", "ending"], "left")
        log = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
        rest = F.element_at(F.lit([float(x) for x in vocabulary.rest]), F.col("ending") + 1)
        joined = left.select("row", F.lit(None).cast(kind).alias("id"), F.lit(0).cast("long").alias("n_tokens"),
                             F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("n_known"), log.alias("words"),
                             (log - F.col("times") * rest).alias("scored"))
        every = sums.union(joined).groupBy("row").agg(
            F.max("id").alias("id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "words", "scored")])
        per_token = float(np.log10(vocabulary.tokens + SMOOTHING * (vocabulary.distinct + 1)))
        return every.select("id", "n_tokens", "n_known", (F.col("words") - F.col("n_tokens") * per_token).alias("base_score"),
                            F.col("scored").alias("score"))


def learn_and_score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    counted: int = COUNTED) -> tuple[NeuralLM, DataFrame]:
    """The model of the rows of ``docs`` where ``learn`` holds, and the scores of all
    rows; texts are read once less than by ``train`` and ``score``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = _word_counts(rows.filter("learn"))
    vocabulary = _vocabulary(counts, words, counted)
    sequences = _sequences(rows, vocabulary)
    lm = NeuralLM(vocabulary, _fitted(sequences, vocabulary), counts)
    return lm, lm._scored(sequences)


def train(docs: DataFrame, text_col: str = "text", words: int = WORDS, counted: int = COUNTED) -> NeuralLM:
    """Model of all texts of ``docs``."""
    return learn_and_score(docs.withColumn("_id", F.lit(0)), F.lit(True), "_id", text_col, words, counted)[0]

"""Log-bilinear scores: counts and the model's probabilities against plain versions,
gradients, held-out gain, pieces of long texts, awkward rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward, doc, frame, write

from claimweave.llm import neural_lm, textbatch
from claimweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def corpus(n=400, seed=0):
    """Two made-up languages in turn, with frequent and rare words."""
    rng = random.Random(seed)
    lex = [[a + b + e for a in "bdg" for b in "aeiou" for e in ends] for ends in (("ka", "ri"), ("ZU", "mo,"))]
    rows = []
    for k in range(n):
        own = lex[k % 2]
        text = [rng.choice(own[:12]) if rng.random() < 0.8 else rng.choice(own) + str(rng.randrange(400)) for _ in range(rng.randrange(3, 60))]
        rows.append(doc(k, ("\n" if k % 7 == 0 else " ").join(text)))
    return rows


def base(rows, train):
    count = Counter(w for text in train for w in words(text))
    count["\n"] = len(train)
    n, v = sum(count.values()), sum(c > 0 for c in count.values())
    out = []
    for text in rows:
        own = [*words(text), "\n"]
        out.append((len(own), sum(count[w] > 0 for w in own),
                    sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)))
    return n, v, count, out


def plain_score(lm, count, text):
    """The model's log10 probability of a text, a token at a time."""
    v = lm.vocabulary
    total, kinds, classes = Counter(), Counter(), {}
    for w in count:
        if w != "\n":
            t = textbatch.to_texts([0], [w.encode()])
            cls = int(v.find(t.hashes(), neural_lm.endings(t))[1][0])
            classes[w] = cls
            total[cls] += count[w]
            kinds[cls] += 1
    before, out = [v.end] * neural_lm.CONTEXT, 0.0
    for w in [*words(text), "\n"]:
        if w == "\n":
            cls = v.end
        else:
            t = textbatch.to_texts([0], [w.encode()])
            cls = classes.get(w, v.words + int(neural_lm.endings(t)[0]))
        p = lm.model.log_softmax(np.array(before[::-1])[:, None])[0]
        out += p[cls] / math.log(10)
        if v.words <= cls < v.end:
            out += math.log10((count[w] + 0.1) / (total[cls] + 0.1 * (kinds[cls] + 1)))
        before = before[1:] + [cls]
    return out


def scored(spark, lm, rows):
    return {r["id"]: r for r in lm.score(frame(spark, rows)).collect()}


def trained(spark, rows, **kw):
    return neural_lm.train(frame(spark, rows).repartition(2), **kw)


@pytest.mark.parametrize("counted", [1 << 18, 10, 0])
def test_equals_plain_versions(spark, counted):
    rows = corpus(120)
    train = [r for r in rows if not held(r[0])]
    lm = trained(spark, train, words=8, counted=counted)
    n, v, count, want = base([r[1] for r in rows], [r[1] for r in train])
    assert (lm.vocabulary.tokens, lm.vocabulary.distinct) == (n, v) and len(lm.vocabulary.counted) <= counted
    got = scored(spark, lm, rows)
    for r, (tokens, known, score) in zip(rows, want, strict=True):
        own = got[r[0]]
        assert (own["n_tokens"], own["n_known"]) == (tokens, known)
        assert abs(own["base_score"] - score) < 1e-9 * tokens
        assert abs(own["score"] - plain_score(lm, count, r[1])) < 1e-4 * tokens


def test_probabilities_add_up(spark):
    lm = trained(spark, corpus(60), words=5)
    v = lm.vocabulary
    _, _, count, _ = base([], [r[1] for r in corpus(60)])
    context = np.random.default_rng(0).integers(0, v.end + 1, (neural_lm.CONTEXT, 3))
    p = np.exp(lm.model.log_softmax(context))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    within = np.zeros(neural_lm.ENDINGS)
    for w in count:
        if w != "\n":
            t = textbatch.to_texts([0], [w.encode()])
            cls, e = int(v.find(t.hashes(), neural_lm.endings(t))[1][0]), int(neural_lm.endings(t)[0])
            if cls >= v.words:
                within[e] += (count[w] + 0.1) / 10 ** v.rest[e]
    assert np.allclose(within + 0.1 / 10 ** v.rest, 1)


def test_gradients():
    rng = np.random.default_rng(1)
    frequency = rng.integers(1, 50, 9).astype(float)
    lm = neural_lm.LogBilinear(9, frequency=frequency)
    lm.arrays = [x.astype(np.float64) for x in lm.arrays]
    seq, context, noise = rng.integers(0, 9, 6), rng.integers(0, 9, (neural_lm.CONTEXT, 6)), rng.integers(0, 9, 5)
    log_noise = np.log(5 * frequency / frequency.sum())
    _, to_context, to_target, to_position = lm.gradients(seq, context, noise, log_noise)
    full = [np.zeros((9, neural_lm.WIDTH)), np.zeros((9, neural_lm.WIDTH + 1)), to_position]
    np.add.at(full[0], *to_context)
    np.add.at(full[1], *to_target)
    full = [full[0], full[1][:, :-1], full[2], full[1][:, -1]]
    for k, x in enumerate(lm.arrays[:4]):
        for at in [tuple(rng.integers(0, s) for s in x.shape) for _ in range(12)]:
            value = []
            for d in (1e-5, -2e-5):
                x[at] += d
                value.append(lm.gradients(seq, context, noise, log_noise)[0]())
            x[at] += 1e-5
            assert abs((value[0] - value[1]) / 2e-5 - full[k][at]) < 1e-4


def test_batched_scores_equal_the_softmax():
    rng = np.random.default_rng(2)
    for scale in (1, 400):  # the larger one overflows without a shift
        lm = neural_lm.LogBilinear(30, frequency=rng.integers(1, 9, 30).astype(float))
        lm.arrays[1] *= scale
        lm.arrays[3] *= scale
        flat = rng.integers(0, 30, 700).astype(np.int16)
        at = np.arange(neural_lm.CONTEXT, 700)
        want = lm.log_softmax(neural_lm.contexts(flat, at))[np.arange(len(at)), flat[at]] / np.log(10)
        assert np.allclose(lm.log10_of(flat, at), want, atol=1e-3, rtol=1e-4)


def test_scoring_takes_no_exponentials_for_tokens(monkeypatch):
    rng = np.random.default_rng(3)
    lm = neural_lm.LogBilinear(20, frequency=rng.integers(1, 9, 20).astype(float))
    flat, done, exp = rng.integers(0, 20, 40_000).astype(np.int16), [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **kw: done.append(np.size(x)) or exp(x, *a, **kw))
    got = lm.log10_of(flat, np.arange(neural_lm.CONTEXT, len(flat)))
    assert len(got) == len(flat) - neural_lm.CONTEXT and sum(done) <= neural_lm.CONTEXT * 20 * 20


def test_scores_beyond_the_reach_of_tables(monkeypatch):
    monkeypatch.setattr(neural_lm, "_TOKENS_AT_ONCE", 50)
    rng = np.random.default_rng(4)
    lm = neural_lm.LogBilinear(12, frequency=rng.integers(1, 9, 12).astype(float))
    lm.arrays[0][3] *= 900  # contexts with this class are beyond reach, some only together
    lm.arrays[0][5] *= 120
    lm.arrays[3] -= 60      # a shift of all biases changes nothing
    flat = np.concatenate([rng.choice([0, 1, 2, 4, 6, 7], 1000), rng.integers(0, 12, 1000)]).astype(np.int16)
    at = np.arange(neural_lm.CONTEXT, 2000)
    r, q, position, bias = (x.astype(np.float64) for x in lm.arrays[:4])
    z = sum(r[flat[at - 1 - j]] * position[j] for j in range(neural_lm.CONTEXT)) @ q.T + bias
    z -= z.max(axis=1, keepdims=True)
    want = (z[np.arange(len(at)), flat[at]] - np.log(np.exp(z).sum(axis=1))) / np.log(10)
    got = lm.log10_of(flat, at)
    assert np.allclose(got, want, atol=2e-5, rtol=1e-5)
    far = sum(x[flat[at - 1 - j]] for j, x in enumerate(lm.tables()[1]))
    assert (far > neural_lm._REACH).any() and (far[:900] < neural_lm._REACH).all()


def test_words_with_one_hash_and_different_endings_count_apart(spark, monkeypatch):
    monkeypatch.setattr(textbatch.Texts, "hashes", lambda t: textbatch.mix(t.length))
    rows = corpus(60)
    met = {w for r in rows for w in words(r[1])}
    kinds = {(len(w.encode()), int(neural_lm.endings(textbatch.to_texts([0], [w.encode()]))[0])) for w in met}
    v = trained(spark, rows).vocabulary
    assert len({n for n, _ in kinds}) < len(kinds) and v.distinct == len(kinds) + 1


def test_held_out_texts_are_better_than_by_frequency(spark):
    rows = corpus(1500)
    lm = trained(spark, [r for r in rows if not held(r[0])])
    own = [r for i, r in scored(spark, lm, rows).items() if held(i)]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own) + 0.1 * sum(r["n_tokens"] for r in own)


def test_long_texts_in_pieces(spark, monkeypatch):
    rows = corpus(30) + [doc(1000, " ".join(r[1] for r in corpus(200, 5)) + " " + "é" * 9000), doc(1001, " \n" * 4000), doc(1002, "x" * 7000)]
    lm = trained(spark, corpus(100))
    whole = scored(spark, lm, rows)
    monkeypatch.setattr(textbatch, "CHUNK", 1500)
    cut = scored(spark, lm, rows)
    for i, r in whole.items():
        assert r["n_tokens"] == cut[i]["n_tokens"] and r["n_known"] == cut[i]["n_known"]
        assert abs(r["score"] - cut[i]["score"]) < 1e-4 * r["n_tokens"] and abs(r["base_score"] - cut[i]["base_score"]) < 1e-6 * r["n_tokens"]
    again = trained(spark, rows)
    assert again.vocabulary.tokens == sum(len(words(r[1])) + 1 for r in rows)


def test_awkward_rows(spark):
    rows = awkward()
    lm = trained(spark, rows)
    got = lm.score(frame(spark, rows)).collect()
    _, _, _, want = base([r[1] for r in rows], [r[1] for r in rows])
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == sorted((a, b, round(c, 4)) for a, b, c in want)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)


def test_nothing_to_learn(spark):
    lm = trained(spark, [])
    got = scored(spark, lm, [doc(1, "a b"), doc(2, None)])
    assert [(got[i]["n_tokens"], got[i]["n_known"], got[i]["base_score"]) for i in (1, 2)] == [(3, 0, 0.0), (1, 0, 0.0)]
    assert abs(got[1]["score"] - 3 * math.log10(1 / (neural_lm.ENDINGS + 1))) < 0.3
    assert lm.score(frame(spark, [])).collect() == []


def test_query(spark, tmp_path):
    rows = corpus(80)
    out = QUERIES["op11_lm_score"](spark, write(spark, tmp_path, documents=frame(spark, rows)))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    train = [r[1] for r in rows if not held(r[0])]
    n, _, _, want = base([r[1] for r in rows], train)
    for r, (tokens, known, score) in zip(rows, want, strict=True):
        own = got[r[0]]
        assert (own["held_out"], own["n_tokens"], own["n_known"], own["train_tokens"]) == (held(r[0]), tokens, known, n)
        assert abs(own["base_score"] - score) < 1e-9 * tokens

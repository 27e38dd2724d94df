"""Toxicity and quality: scores against plain versions, held-out accuracy, awkward rows."""

import itertools
import random

import numpy as np
from llm_cases import awkward, doc, frame, prose

from claimweave.llm import quality, toxicity
from claimweave.llm.folds import held_out, labelled
from claimweave.llm.textbatch import to_texts

BAD = ["vilex", "scumy", "idiotz"]


def toxic_text(k):
    rng = random.Random(k)
    words = prose(k, 40).split()
    for w in rng.sample(BAD, 2) + [f"lowei{rng.choice('abcdefg')}{rng.choice('xyz')}"]:
        words.insert(rng.randrange(len(words)), w)
    return " ".join(words)


def train_rows(spark):
    rows = [(1, toxic_text(k)) for k in range(60)] + [(0, prose(1000 + k, 40)) for k in range(240)] + [(None, "x"), (1, None)]
    return spark.createDataFrame(rows, "label int, text string")


def brute_segments(score):
    """Maximal segments by their definition: best first, then left and right of it."""
    def best(lo, hi):
        found = None
        for i, j in itertools.combinations(range(lo, hi + 1), 2):
            s = sum(score[i:j])
            if s > 1e-12 and (found is None or s > found[2] + 1e-12):
                found = (i, j, s)
        return found

    def split(lo, hi):
        b = best(lo, hi)
        return split(lo, b[0]) + [b] + split(b[1], hi) if b else []

    return split(0, len(score))


def test_maximal_segments_equal_definition():
    rng = random.Random(3)
    for _ in range(60):
        score = np.array([rng.choice([-toxicity.DRIFT] * 3 + [0.7, 1.9, 3.1]) for _ in range(14)])
        got = toxicity.maximal_segments(np.flatnonzero(score > 0), score)
        assert [(a, b + 1, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in brute_segments(list(score))]


def test_extreme_value_constant(spark):
    model = toxicity.train(train_rows(spark))
    base = model.n1 / (model.n1 + model.n0)
    s = model._odds(model.y1, model.y0, np.full(len(model.known), base)) - toxicity.DRIFT
    p = (model.y0 + toxicity.PRIOR * (1 - base)) / (model.n0 + toxicity.PRIOR)
    up = s > 0
    total = (p[up] * np.exp(model.decay * s[up])).sum() + (1 - p[up].sum()) * np.exp(-model.decay * toxicity.DRIFT)
    assert abs(total - 1) < 1e-6 and model.decay > 0


def test_toxicity_scores(spark):
    model = toxicity.train(train_rows(spark))
    rows = [doc(k, toxic_text(500 + k)) for k in range(30)] + [doc(100 + k, prose(2000 + k, 40)) for k in range(30)]
    rows += [doc(200, prose(7, 40) + " loweibz and loweigy here"), doc(201, prose(8, 300) + toxic_text(900))]
    df = frame(spark, rows)
    got = {r["doc_id"]: r for r in df.select("doc_id", "text", model.column(df["text"]).alias("f")).collect()}
    assert all((got[i]["f"]["score"] >= 0.5) == (i < 100 or i >= 200) for i in got)
    for i in (0, 201):
        covered = " ".join(got[i]["text"].encode()[p["begin"]:p["end"]].decode() for p in got[i]["f"]["passages"])
        assert any(w in covered for w in BAD)


def test_toxicity_awkward(spark):
    model = toxicity.train(train_rows(spark))
    rows = awkward()
    df = frame(spark, rows)
    got = df.select(model.column(df["text"]).alias("f")).collect()
    assert len(got) == len(rows) and all(r["f"]["score"] < 0.5 and r["f"]["passages"] == [] for r in got)
    for some in ([], [(0, "a b c")], [(1, "a b c")]):
        own = toxicity.train(spark.createDataFrame(some, "label int, text string"))
        scores = {r["f"]["score"] for r in df.select(own.column(df["text"]).alias("f")).collect()}
        assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_copies_do_not_make_words_toxic(spark):
    copy = prose(4, 40).replace("the", "uncommonword") + " vilex"
    rows = [(1, copy)] * 50 + [(1, toxic_text(k)) for k in range(60)] + [(0, prose(1000 + k, 40)) for k in range(240)]
    model = toxicity.train(spark.createDataFrame(rows, "label int, text string"))
    t = to_texts([0], [copy.encode()]).trimmed()
    score = model.scores(t)
    assert score[-1] > 0 and (score[:-1] < 0).all()


def test_labelled_rows(spark):
    docs = frame(spark, [doc(1, "a"), doc(2, "b"), doc(2, "b"), doc(3, "c"), doc(None, "d"), doc(4, "e")])
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id bigint, toxic int")
    got = sorted(map(tuple, labelled(docs, labels, "toxic", ["text"], ~held_out("doc_id", 5, 9)).collect()))
    assert got == [(0, "b"), (0, "b"), (1, "a")]


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    model = quality.QualityModel(0.3, rng.normal(size=quality.WIDTH), rng.normal(size=(quality.WIDTH, quality.RANK)))
    feature, value = rng.choice(quality.WIDTH, 9, replace=False), rng.normal(size=9)
    pairs = sum(model.factor[a] @ model.factor[b] * x * y for (a, x), (b, y) in itertools.combinations(zip(feature, value), 2))
    want = 0.3 + model.weight[feature] @ value + pairs
    assert abs(model.raw(np.zeros(9, int), feature, value, 1)[0] - want) < 1e-9


def quality_rows(spark, lo, n):
    rows = []
    for k in range(lo, lo + n):
        rows += [(1, prose(k, 60).capitalize() + ".", None), (0, "!! ".join(prose(k + 5000, 30).upper().split()), 3),
                 (0, " ".join([prose(k, 1)] * 40), 100), (1, "\n".join(prose(k * 9 + i, 30) for i in range(4)), 500)]
    return spark.createDataFrame(rows, "label int, text string, n_chars bigint")


def test_quality_held_out(spark):
    model = quality.train(quality_rows(spark, 0, 60))
    df = quality_rows(spark, 100, 25)
    got = df.select("label", model.column(df["text"], df["n_chars"]).alias("score")).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["label"] == 1) for r in got]) >= 0.97


def test_quality_is_repeatable_and_whole(spark):
    df = quality_rows(spark, 0, 20)
    a, b = quality.train(df), quality.train(df.repartition(5))
    assert np.array_equal(a.weight, b.weight) and np.array_equal(a.factor, b.factor)
    rows = awkward()
    docs = frame(spark, rows)
    got = docs.select("doc_id", a.column(docs["text"], docs["n_chars"]).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r["s"] <= 1 for r in got)


def test_quality_without_both_labels(spark):
    df = frame(spark, [doc(1, "a b"), doc(2, None)])
    for some, want in (([], 0.5), ([(1, "a", 1)], 1.0), ([(0, "a", 1), (None, "b", 2)], 0.0)):
        model = quality.train(spark.createDataFrame(some, "label int, text string, n_chars bigint"))
        assert all(abs(r["s"] - want) < 1e-9 for r in df.select(model.column(df["text"], df["n_chars"]).alias("s")).collect())


def test_queries_on_held_out_rows(spark):
    from claimweave.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    for name, column, least in (("op3_toxicity", "toxic", 0.93), ("op8_quality", "quality", 0.9)):
        got = QUERIES[name](spark, sf).toPandas().merge(labels, on="doc_id")
        assert (got[got.held_out].predicted == got[got.held_out][column]).mean() >= least, name

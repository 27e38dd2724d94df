"""The registered queries' scores against plain versions that work a word or a pair at a time."""

import itertools
import math
import re

import numpy as np
from test_classifiers import brute_segments
from test_embeddings import SCHEMA, brute, vectors

from claimweave.llm import language, quality, toxicity
from claimweave.llm.folds import held_out, labelled
from claimweave.llm.queries import QUERIES
from claimweave.llm.textbatch import to_texts

FOLDER = "/root/testdata/sf0.001"


def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels")]


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


# ---------------------------------------------------------------- language ID

def gram_bucket(chars, bits):
    g = 0
    for c in chars:
        g = (g << 8 | c) & 0xFFFFFFFF
    g = (g ^ g >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
    g = (g ^ g >> 12) * 0x297A2D39 & 0xFFFFFFFF
    return g >> 32 - bits


def plain_language(model, text):
    logs = []
    for word in words_of(text):
        word, own, run = bytes(c + 32 if 65 <= c <= 90 else c for c in word), np.zeros(len(model.names)), []
        met = False
        for c in word:
            run = (run + [c])[-4:] if 97 <= c <= 122 or c >= 128 else []
            if run:
                own += model.logs[gram_bucket(run, model.bucket_bits)]
                met = True
        if met:
            logs.append(own)
    if not logs or not any(c.isalpha() for c in text):
        return language.UNDETERMINED, 0.0
    logs = np.array(logs)
    best, n = logs.max(axis=1, keepdims=True), len(logs)
    p = np.exp(np.maximum(logs - best, -30))

    def em(share):
        for _ in range(language.ROUNDS):
            r = p * share
            share = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        return share

    share = em(np.full(len(model.names), 1 / len(model.names)))
    single = (logs - best).sum(axis=0)
    chosen, value = np.eye(len(model.names))[single.argmax()], single.max()
    order = np.argsort(-share, kind="stable")
    for k in range(2, len(model.names) + 1):
        if value >= -language.PENALTY * (k - 1) * math.log(n):
            break
        prior = np.where(np.isin(np.arange(len(share)), order[:k]), share, 0)
        fit = em(prior / prior.sum())
        gain = np.log(np.maximum((p * fit).sum(axis=1), 1e-30)).sum() - language.PENALTY * (k - 1) * math.log(n)
        if gain > value:
            value, chosen = gain, fit
    return model.names[int(chosen.argmax())], float(chosen.max())


def test_languages_equal_a_plain_version(spark):
    docs, _ = tables(spark)
    model = language.train(docs.filter(~held_out("doc_id", 4, 2)))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in QUERIES["op9_language_id"](spark, FOLDER).collect():
        name, score = plain_language(model, text[r["doc_id"]])
        assert r["lang_pred"] == name and abs(r["score"] - score) < 2e-3


# ---------------------------------------------------------------- quality

def test_quality_equals_all_pairs(spark):
    docs, labels = tables(spark)
    model = quality.train(labelled(docs, labels, "quality", ["text", "n_chars"], ~held_out("doc_id", 5, 0), most=quality.MOST_TRAINED))
    rows = {r["doc_id"]: r for r in docs.collect()}
    got = QUERIES["op8_quality"](spark, FOLDER).collect()
    assert len({round(r["score"], 3) for r in got}) > 20
    for r in got:
        own = rows[r["doc_id"]]
        known = own["n_chars"] is not None
        _, f, x = quality.features(to_texts([0], [(own["text"] or "").encode()]), np.array([float(own["n_chars"] or 0)]), np.array([known]))
        weighed = model.factor[f] * x[:, None]
        between = weighed @ weighed.T
        raw = model.bias + model.weight[f] @ x + between[np.triu_indices(len(f), 1)].sum()
        assert abs(r["score"] - 1 / (1 + math.exp(-max(-30, min(30, raw))))) < 1e-6


# ---------------------------------------------------------------- toxicity

def plain_toxicity(model, text):
    """Score of a text: its words one by one, segments by their definition."""
    trimmed = [w for w in (re.sub(rb"^[^0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+$", b"", w) for w in words_of(text)) if w]
    base = model.n1 / (model.n1 + model.n0)
    place = {int(h): k for k, h in enumerate(model.known)}
    scores = []
    for w in trimmed:
        t = to_texts([0], [w]).trimmed()
        h, prefixes = toxicity.terms(t)
        own = place.get(int(h[0]))
        stem = next((place[int(p[0])] for p in prefixes if int(p[0]) in place), None)
        term = own if own is not None else stem
        s = 0.0
        if term is not None:
            share = base
            if own is not None and stem is not None:
                share = (model.y1[stem] + base) / (model.y1[stem] + model.y0[stem] + 1)
            a, b = model.y1[term] + toxicity.PRIOR * share, model.y0[term] + toxicity.PRIOR * (1 - share)
            odds = math.log(a / model.n1) - math.log(b / model.n0)
            if odds / math.sqrt(1 / a + 1 / max(b, 0.5)) >= toxicity.LEAST_Z:
                s = min(odds, toxicity.MOST_ODDS)
        scores.append(s - toxicity.DRIFT)
    worst = math.log(model.spread * len(scores)) if scores else 0.0
    found = [model.decay * s - worst for _, _, s in brute_segments(scores)] if scores else []
    found = [e for e in found if e > 0]
    logs = [math.log1p(sum(found)), math.log1p(max(found))] if found else [0.0, 0.0]
    raw = model.level + sum(a * b for a, b in zip(model.slopes, logs))
    return 1 / (1 + math.exp(-raw)), len(found)


def test_toxicity_equals_a_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")]
    model = toxicity.train(labelled(docs, labels, "toxic", ["text"], ~held_out("doc_id", 5, 0)))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    # The definition of segments takes the cube of a text's words.
    short = [r for r in QUERIES["op3_toxicity"](spark, folder).collect() if len(words_of(text[r["doc_id"]])) <= 60]
    some = 0
    for r in short:
        score, n = plain_toxicity(model, text[r["doc_id"]])
        assert abs(r["score"] - score) < 1e-6 and r["n_passages"] == n
        some += n
    assert len(short) > 50 and some > 0


# ---------------------------------------------------------------- embeddings

def test_query_links_a_table_with_links(spark, tmp_path):
    rows = [(k, v, k % 3 % 2, 0, "x") for k, v in enumerate(vectors(9))]
    rows += [(5000 + k, rows[0][1], 0, 0, "x") for k in range(60)] + [(6000, None, 0, 0, "x"), (6001, rows[0][1], None, 0, "x")]
    spark.createDataFrame(rows, SCHEMA.format(kind="float")).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in QUERIES["op5_embedding_near_dedup"](spark, str(tmp_path)).collect()}
    want = {i: (n, c) for i, n, c in brute(rows)}
    assert set(got) == set(want) and sum(n for n, _ in want.values()) > 3000
    assert all(r["n_links"] <= want[i][0] and r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert sum(r["component_id"] == want[i][1] for i, r in got.items()) >= 0.98 * len(want)


def test_plain_versions_notice_a_wrong_model(spark):
    """A sign turned in the operator's model changes what the plain versions give."""
    docs, labels = tables(spark)
    model = language.train(docs)
    texts = [r["text"] for r in docs.limit(40).collect()]
    before = [plain_language(model, t) for t in texts]
    model.logs = -model.logs
    assert sum(a != b for a, b in itertools.zip_longest(before, [plain_language(model, t) for t in texts])) > 20


def test_languages_of_long_texts_in_pieces(spark, monkeypatch):
    from claimweave.llm import textbatch

    docs, _ = tables(spark)
    model = language.train(docs)
    some = [r["text"] for r in docs.limit(30).collect()]
    rows = [(1, " ".join(some)), (2, some[0]), (3, " 12 \n" * 900), (4, "☃ " * 900 + "é"), (5, None), (6, " ".join(some[:4]) + " " * 3000)]
    df = spark.createDataFrame(rows, "i int, text string")
    found = lambda: {r["i"]: r["f"] for r in df.select("i", model.column(df["text"]).alias("f")).collect()}
    whole = found()
    counts = language.train(docs).logs
    monkeypatch.setattr(textbatch, "CHUNK", 700)
    cut = found()
    assert {i: f["lang"] for i, f in cut.items()} == {i: f["lang"] for i, f in whole.items()}
    assert all(abs(cut[i]["score"] - f["score"]) < 1e-4 for i, f in whole.items())
    assert whole[3]["lang"] == whole[5]["lang"] == language.UNDETERMINED != whole[4]["lang"]
    assert np.array_equal(language.train(docs).logs, counts)

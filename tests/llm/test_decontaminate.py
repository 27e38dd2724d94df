import random
import tracemalloc

import numpy as np

from llm_cases import awkward, doc, frame, prose

from claimweave.llm import decontaminate

ITEM = "item_id bigint, text string, doc_id int"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], ITEM)


def found(spark, docs, bench):
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(frame(spark, docs), items(spark, bench)).collect()}


def brute_score(item: list[str], words: list[str]) -> float:
    """Plain Smith-Waterman over words."""
    best, above = 0, [0] * (len(words) + 1)
    for a in item:
        now = [0]
        for j, b in enumerate(words, 1):
            now.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 1, now[-1] - 1))
        best, above = max(best, *now), now
    return best / (2 * len(item))


def edited(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [w, "inserted"] if x < 2 * share / 3 else ["other"] if x < share else [w]
    return out


def test_exact_edited_and_clean(spark):
    rng = random.Random(4)
    bench = [(k, prose(k * 11 + 3, 30)) for k in range(6)]
    docs, want = [], set()
    for k, (i, text) in enumerate(bench):
        words = text.split()
        docs.append(doc(100 + k, prose(200 + k) + "\n" + text.upper().replace(" ", ", ") + "\n" + prose(300 + k)))
        docs.append(doc(200 + k, prose(400 + k) + " " + " ".join(edited(rng, words, 0.2)) + " " + prose(500 + k)))
        docs.append(doc(300 + k, prose(1000 + 13 * k, 60)))
        want |= {(100 + k, i), (200 + k, i)}
    got = found(spark, docs, bench)
    assert set(got) == want
    text = {d[0]: d[1] for d in docs}
    for (d, i), r in got.items():
        plain = text[d].lower().replace(",", "").split()
        assert abs(r["score"] - brute_score(dict(bench)[i].split(), plain)) < 1e-9
        span = text[d].encode()[r["begin"]:r["end"]].decode().lower().replace(",", "").split()
        assert abs(brute_score(dict(bench)[i].split(), span) - r["score"]) < 1e-9
        if d < 200:
            assert span == dict(bench)[i].split()


def test_common_passage_still_matches(spark):
    """An item that most documents hold has rare seeds all the same."""
    bench = [(1, prose(3, 30)), (2, prose(60, 30))]
    docs = [doc(k, prose(100 + k) + " " + bench[0][1]) for k in range(40)]
    assert set(found(spark, docs, bench)) == {(k, 1) for k in range(40)}


def test_passages_of_long_items(spark):
    """A verbatim passage counts, however small a part of its item it is."""
    item = prose(9001, 400)
    words = item.split()
    docs = [doc(1, f"{prose(9100)} {' '.join(words[100:250])} {prose(9101)}"), doc(2, " ".join(words[:40])),
            doc(3, f"{prose(9102)} {' '.join(words[60:75])} {prose(9103)}"), doc(4, prose(9104, 400))]
    got = found(spark, docs, [(7, item)])
    assert set(got) == {(1, 7), (2, 7)}
    assert 0.37 < got[1, 7]["score"] < 0.4
    text = docs[0][1].encode()[got[1, 7]["begin"]:got[1, 7]["end"]].decode()
    assert " ".join(words[100:250]) in text and len(text.split()) < 165


def test_awkward_rows(spark):
    rows = awkward()
    bench = [(1, prose(1)), (2, None), (3, ""), (4, "two words"), (None, prose(5)), (6, prose(1))]
    got = decontaminate.contaminated(frame(spark, rows), items(spark, bench)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (1, 6), (6, 1), (6, 6)]
    assert found(spark, rows, []) == {}
    assert found(spark, [], bench) == {}


def test_long_texts_in_pieces(spark, monkeypatch):
    """Grams, places and stretches across the pieces of a long text."""
    from claimweave.llm import textbatch
    bench = [(k, prose(k * 11 + 3, 30)) for k in range(5)] + [(9, prose(77, 300))]
    rows = [doc(1, "\n".join(prose(600 + k, 40) + " -- " + bench[k % 6][1] for k in range(12))), doc(2, bench[2][1]),
            doc(3, prose(700, 500) + " " + bench[5][1][20:] + " " + prose(701, 400))]
    whole = found(spark, rows, bench)
    monkeypatch.setattr(textbatch, "CHUNK", 150)
    assert found(spark, rows, bench) == whole
    assert set(whole) == {(1, i) for i, _ in bench} | {(2, 2), (3, 9)}


def test_hot_items_and_texts(spark):
    """A third of the documents are one text, a third of the items are one item."""
    bench = [(k, prose(k * 11 + 3, 30)) for k in range(20)] + [(100 + k, prose(3, 30)) for k in range(10)]
    docs = [doc(k, prose(1) + " " + bench[0][1]) for k in range(200)] + [doc(1000 + k, prose(2000 + k) + " " + bench[k % 20][1]) for k in range(400)]
    same = [0, *range(100, 110)]
    want = {(k, i) for k in range(200) for i in same}
    want |= {(1000 + k, i) for k in range(400) for i in (same if k % 20 == 0 else [k % 20])}
    assert set(found(spark, docs, bench)) == want


def test_no_item_is_collected_or_shipped(spark):
    """Beside the filter of bounded size, the benchmark stays in Spark: its size is no row of a driver's list."""
    many = spark.range(40_000).selectExpr(
        "id as item_id", "concat_ws(' ', transform(sequence(1, 12), k -> concat('w', substr(sha1(concat(id, '.', k)), 1, 6)))) as text")
    docs = many.filter("item_id % 1000 = 7").selectExpr("item_id as doc_id", "concat('and so ', text, ' it went') as text")
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in decontaminate.contaminated(docs, many).collect()}
    assert got == {(i, i, 1.0) for i in range(7, 40_000, 1000)}


def test_query_equals_brute_force(spark):
    from claimweave.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op2_decontamination"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    exact = {(d["doc_id"], b["item_id"]) for d in docs for b in bench if b["text"] in d["text"]}
    assert exact and exact <= got
    text = {d["doc_id"]: d["text"] for d in docs}
    item = {b["item_id"]: b["text"] for b in bench}
    clean = lambda t: [w for w in ("".join(c if c.isalnum() else " " for c in x).strip() for x in t.lower().split()) if w]
    for d, i in got - exact:
        assert brute_score(clean(item[i]), clean(text[d])) >= 0.5


def test_filter_holds_every_gram(spark):
    rng = np.random.default_rng(1)
    grams = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    held = decontaminate.GramFilter(spark.createDataFrame([(int(g),) for g in grams], "gram long"))
    assert held.may_hold(grams.view(np.uint64)).all()
    assert held.may_hold(rng.integers(0, 1 << 63, 100_000).astype(np.uint64)).mean() < 0.03


def test_span_of_a_long_item_in_one_row_of_memory():
    rng = np.random.default_rng(2)
    item = rng.integers(1, 1 << 40, 20_000).astype(np.uint64)
    window = np.concatenate([rng.integers(1, 1 << 40, 3000).astype(np.uint64), item[5000:5060], rng.integers(1, 1 << 40, 2000).astype(np.uint64)])
    tracemalloc.start()
    assert decontaminate._span(item, window) == (3000, 3060)
    assert tracemalloc.get_traced_memory()[1] < 20 << 20
    tracemalloc.stop()


def test_spans_score_as_the_best_alignment():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item, window = rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 20)).astype(np.uint64)
        a, b = decontaminate._span(item, window)
        best = brute_score(list(item), list(window))
        assert brute_score(list(item), list(window[a:b])) == best and (best > 0 or a == b)

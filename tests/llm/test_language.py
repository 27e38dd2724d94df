from llm_cases import awkward, doc, frame, prose

from claimweave.llm import language
from claimweave.llm.folds import held_out

FRENCH = "le renard brun saute par dessus le chien paresseux et la lune est verte sur la colline ancienne".split()


def french(k):
    return " ".join(FRENCH[(k * 3 + i) % len(FRENCH)] for i in range(25))


def scored(spark, model, rows):
    df = frame(spark, rows)
    return {(r["doc_id"], r["text"]): r["found"] for r in df.select("doc_id", "text", model.column(df["text"]).alias("found")).collect()}


def model_of(spark):
    return language.train(frame(spark, [doc(i, prose(i), "en") for i in range(20)] + [doc(i, french(i), "fr") for i in range(20, 40)]
                                + [doc(41, None, "en"), doc(42, prose(3), None)]))


def test_languages_and_mixture(spark):
    model = model_of(spark)
    assert model.names == ["en", "fr"]
    got = scored(spark, model, [doc(1, prose(77)), doc(2, french(31)), doc(3, prose(50) + " " + french(50))])
    by = {k[0]: v for k, v in got.items()}
    assert (by[1]["lang"], by[2]["lang"]) == ("en", "fr")
    assert by[1]["score"] == 1.0
    assert {x.split(":")[0] for x in by[3]["languages"].split(",")} == {"en", "fr"}
    assert 0.4 < by[3]["score"] < 0.6


def test_awkward_rows(spark):
    model = model_of(spark)
    rows = awkward()
    got = scored(spark, model, rows)
    assert len(got) == len({(r[0], r[1]) for r in rows})
    und = {k[0] for k, v in got.items() if v["lang"] == "und"}
    assert und == {2, 3, 4, 9}
    assert all(0 <= v["score"] <= 1 for v in got.values())
    assert all(v["score"] == 0 for v in got.values() if v["lang"] == "und")
    assert scored(spark, model, [doc(1, "☃☃ … 123")])[(1, "☃☃ … 123")]["lang"] == "und"
    assert scored(spark, model, []) == {}


def made_up(name, k, n):
    """n words of a language with an alphabet of its own."""
    return " ".join("".join(name[(k * 7 + i * 5 + j * j) % len(name)] for j in range(6)) for i in range(n))


def test_every_language_counts(spark):
    """Sets grow to all languages, however small a language's share is."""
    letters = {"aa": "abcde", "bb": "fghij", "cc": "klmno", "dd": "pqrst", "ee": "uvwxy"}
    model = language.train(frame(spark, [doc(100 * i + k, made_up(x, k, 50), lang) for i, (lang, x) in enumerate(letters.items())
                                         for k in range(10)]))
    mixed = lambda **n: " ".join(made_up(letters[x], 3, k) for x, k in n.items())
    want = {1: dict.fromkeys(letters, 0.2), 2: {"aa": 0.35, "bb": 0.22, "cc": 0.22, "dd": 0.21},
            3: {"aa": 1478 / 1500, "bb": 22 / 1500}, 4: {"aa": 1 - 8 / 4000, "ee": 8 / 4000}}
    rows = [doc(1, mixed(**dict.fromkeys(letters, 40))), doc(2, mixed(aa=350, bb=220, cc=220, dd=210)),
            doc(3, mixed(aa=1478, bb=22)), doc(4, mixed(aa=3992, ee=8))]
    got = {k[0]: v for k, v in scored(spark, model, rows).items()}
    for i, shares in want.items():
        found = {x.split(":")[0]: float(x.split(":")[1]) for x in got[i]["languages"].split(",")}
        assert set(found) == set(shares)
        assert all(abs(found[x] - share) < 0.01 for x, share in shares.items())
        assert abs(got[i]["score"] - max(shares.values())) < 0.01


def test_nothing_to_learn(spark):
    model = language.train(frame(spark, [doc(1, None), doc(2, prose(1), None)]))
    assert scored(spark, model, [doc(1, prose(1))])[(1, prose(1))]["lang"] == "und"


def test_em_follows_known_shares():
    import numpy as np
    p = np.array([[1, .01]] * 6 + [[.01, 1]] * 2, np.float32)
    share = language._em(p, np.array([0]), np.zeros(8, int), np.array([8]), np.full((1, 2), .5, np.float32))
    assert abs(share[0, 0] - 0.75) < 0.02


def test_held_out_accuracy(spark):
    from claimweave.llm.queries import QUERIES
    got = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.001").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang").toPandas()
    m = got.merge(docs, on="doc_id")
    assert (m[m.held_out].lang_pred == m[m.held_out].lang).mean() >= 0.95


def test_held_out_fold(spark):
    import zlib
    got = {r[0]: r[1] for r in spark.range(50).select("id", held_out("id", 4, 2)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}

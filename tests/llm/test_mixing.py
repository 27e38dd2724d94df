from fractions import Fraction

from llm_cases import awkward, doc, frame, prose, write
from pyspark.sql import functions as F

from claimweave.llm import mixing


def fill(sizes: dict, share=Fraction(3, 2), most=2, weights=(3, 1, 2)) -> dict:
    """Exact water-filling, one source clamped at a time."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {}, set(sizes), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in free}
        for s in above:
            target[s] = Fraction(most * sizes[s])
        left -= sum(target[s] for s in above)
        free -= above
    return target


def mixed(spark, rows):
    measured = mixing.measure(frame(spark, rows))
    return mixing.plan(measured).apply(measured).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "taken").collect()


def check(rows, got):
    size = lambda t: len([w for w in (t or "").encode().split()])
    sizes: dict = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    target = fill(sizes)
    assert sorted(str((r["doc_id"], r["size"])) for r in got) == sorted(str((r[0], size(r[1]))) for r in rows)
    taken: dict = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) <= 1e-6 * max(1, target[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    return taken, target


def test_targets_are_met(spark):
    rows = [doc(k, prose(k, 3 + k * 7 % 40), source=f"s{k % 5 if k % 3 else 0}") for k in range(120)]
    got = mixed(spark, rows)
    taken, target = check(rows, got)
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in target)
    again = mixed(spark, list(reversed(rows)))
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_awkward_rows(spark):
    rows = awkward()
    taken, target = check(rows, mixed(spark, rows))
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)
    assert mixed(spark, []) == []
    assert [r["taken"] for r in mixed(spark, [doc(1, None), doc(2, "")])] == [0, 0]


def test_repeated_rows_divide_the_end(spark):
    rows = [doc(1, prose(1, 20), source="a")] * 6 + [doc(2, prose(2, 200), source="b")]
    taken, target = check(rows, mixed(spark, rows))
    assert all(abs(taken[s] - target[s]) <= 6 for s in target)


def test_size_counts_words(spark):
    texts = ["", "a", " a\tb\nc\x0bd\x0ce\rf ", "é ü x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixing.size(F.col("t"))).collect()] == [0, 1, 6, 2, 0]


def test_query_equals_oracle(spark, tmp_path):
    from oracle_compare import compare, duck

    from claimweave.llm.queries import ORACLE_SQL, QUERIES
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op6_mixing"](spark, sf).toArrow()
    assert compare(got, duck(sf).sql(ORACLE_SQL["op6_mixing"]).to_arrow_table()) == []

"""Operators against brute-force expectations, including the NULL rules."""

from __future__ import annotations

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from claimweave import operators as op


def keys_of(df, col="k"):
    return sorted((r[col] for r in df.collect()), key=lambda x: (x is None, x))


def py_not_in(x, s):
    """SQL three-valued ``x NOT IN s`` -> True / False / None."""
    if not s:
        return True
    if x is None:
        return None
    if x in s:
        return False
    return None if any(v is None for v in s) else True


SETS = [[], [1, 2], [1, None], [None], [3]]
LEFT = [1, 2, 3, None]


@pytest.mark.parametrize("right", SETS)
def test_not_in_matches_sql_semantics(spark, right):
    left = spark.createDataFrame([(x,) for x in LEFT], "k long")
    rdf = spark.createDataFrame([(x,) for x in right], "v long")
    got = keys_of(op.not_in(left, "k", rdf, "v"))
    want = sorted([x for x in LEFT if py_not_in(x, right) is True], key=lambda x: (x is None, x))
    assert got == want
    # Spark SQL's own NOT IN agrees.
    left.createOrReplaceTempView("l_tmp")
    rdf.createOrReplaceTempView("r_tmp")
    sql = keys_of(spark.sql("SELECT k FROM l_tmp WHERE k NOT IN (SELECT v FROM r_tmp)"))
    assert got == sql


def test_not_in_plan_has_no_nested_loop_or_null_aware_join(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).withColumnRenamed("id", "v")
    plan = op.not_in(left, "k", right, "v")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"LeftAnti, Build\w+, true", plan)


def test_semi_in_drops_null_keys(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k long")
    right = spark.createDataFrame([(1,), (None,), (1,)], "v long")
    assert keys_of(op.semi_in(left, "k", right, "v")) == [1]


@pytest.mark.parametrize("cands", list(itertools.product([[], [1], [1, None], [2, 3]], repeat=3))[::5])
def test_classify_by_priority_matches_chained_not_in(spark, cands):
    frames = [(str(i), spark.createDataFrame([(x,) for x in c], "k long")) for i, c in enumerate(cands)]
    got = sorted(((r["tipo"], r["k"]) for r in op.classify_by_priority(frames, "k").collect()),
                 key=lambda t: (t[0], t[1] is None, t[1]))
    outputs, want = [], []
    for i, c in enumerate(cands):
        claimed = [x for o in outputs for x in o]
        out = [x for x in c if i == 0 or py_not_in(x, claimed) is True]
        outputs.append(out)
        want += [(str(i), x) for x in out]
    assert got == sorted(want, key=lambda t: (t[0], t[1] is None, t[1]))


def test_ordered_list_sorted_nulls_skipped_group_kept(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), ("a", None), ("a", "b"), ("c", None)], "g string, v string")
    got = {r["g"]: r["list"] for r in op.ordered_list(df, ["g"], "v", ",").collect()}
    assert got == {"a": "b,b,z", "c": None}


def test_aligned_lists_skip_nulls_per_list(spark):
    rows = [("m", "D2", "2020-01-01"), ("m", "D1", None), ("m", None, "2019-01-01")]
    df = spark.createDataFrame(rows, "m string, k string, v string")
    r = op.aligned_lists(df, ["m"], "k", "v").first()
    # Sorted by (k, v) with NULLs first; each list drops its own NULLs.
    assert (r["first_list"], r["second_list"]) == ("D1,D2", "2019-01-01,2020-01-01")


def test_first_pair_keeps_code_and_name_together(spark):
    rows = [("e", "C2", "ANA-MARIA"), ("e", "C1", "LUIS"), ("e", "C1", "RAUL"), ("e", None, "ADA"), ("f", None, "ZOE")]
    df = spark.createDataFrame(rows, "e string, c string, n string")
    got = {r["e"]: (r["code"], r["name"]) for r in op.first_pair(df, ["e"], "c", "n").collect()}
    assert got == {"e": ("C1", "LUIS"), "f": (None, None)}
    lists = {r["e"]: r for r in op.aligned_lists(df, ["e"], "c", "n", "-", "codes", "names", "first").collect()}
    assert tuple(lists["e"]["first"]) == ("C1", "LUIS") and lists["f"]["first"] is None
    assert lists["e"]["codes"] == "C1-C1-C2"


def test_repeat_flag_counts_distinct_events(spark):
    rows = [("m", "d", 1), ("m", "d", 1), ("m", "d", 2), ("n", "d", 1), ("n", "d", 1)]
    df = spark.createDataFrame(rows, "m string, d string, c long")
    assert sorted(r["m"] for r in op.repeat_flag(df, ["m", "d"], "c", 2).collect()) == ["m"]


def test_latest_per_key_equals_row_number_one(spark):
    t = dt.datetime
    rows = [("u", t(2020, 1, 1), 1), ("u", t(2021, 1, 1), 2), ("u", None, 3), ("v", None, 4), ("v", None, 5)]
    df = spark.createDataFrame(rows, "u string, ts timestamp_ntz, id long")
    got = {r["u"]: r["id"] for r in op.latest_per_key(df, ["u"], ["ts", "id"]).collect()}
    ranked = op.rank_desc(df, ["u"], ["ts", "id"]).where("r = 1")
    assert got == {r["u"]: r["id"] for r in ranked.collect()} == {"u": 2, "v": 5}
    latest = {r["u"]: r["ts"] for r in op.latest_value_per_key(df, ["u"], "ts").collect()}
    assert latest == {"u": t(2021, 1, 1), "v": None}


def test_explode_rows_outer_keeps_empty_and_null(spark):
    df = spark.createDataFrame([(1, [10, 11]), (2, []), (3, None)], "id long, xs array<long>")
    got = sorted((r["id"], r["x"]) for r in op.explode_rows(df, "xs", "x").collect())
    assert got == [(1, 10), (1, 11), (2, None), (3, None)]
    inner = sorted((r["id"], r["x"]) for r in op.explode_rows(df, "xs", "x", outer=False).collect())
    assert inner == [(1, 10), (1, 11)]


def test_both_feeds_distinct_per_branch_only(spark):
    df = spark.createDataFrame([("M", 1), ("M", 1), ("N", 1)], "f string, v long")
    out = op.both_feeds(lambda f: df.where(F.col("f") == f).select("v"), ("M", "N"), distinct_each=True)
    assert out.count() == 2


def test_latest_snapshot_is_a_scalar_subquery(spark):
    snaps = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 4, 1),), (dt.date(2024, 5, 1),)],
                                  "periodo date")
    df = snaps.where(F.col("periodo") == op.latest_snapshot(snaps, "2024-04-15"))
    assert [r[0] for r in df.collect()] == [dt.date(2024, 4, 1)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rank_desc_split_equals_window_with_a_hot_key(spark):
    # one key holds most rows; ties on ts are broken by id
    rows = [("hot", i % 7, i) for i in range(3000)] + [(f"k{i % 40}", i % 5, 10000 + i) for i in range(400)]
    rows += [("nul", None, 20000), ("nul", 3, 20001)] + [(None, i % 3, 30000 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, ts long, id long")
    want = {(r["k"], r["id"]): r["r"] for r in op.rank_desc(df, ["k"], ["ts", "id"]).collect()}
    got = {(r["k"], r["id"]): r["r"] for r in op.rank_desc_split(df, ["k"], ["ts", "id"], partitions=8).collect()}
    assert got == want


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_vals = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=8)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=_vals, right=_vals)
def test_not_in_and_semi_in_random(spark, left, right):
    ldf = spark.createDataFrame([(i, x) for i, x in enumerate(left)], "i long, k long")
    rdf = spark.createDataFrame([(x,) for x in right], "v long")
    got = sorted(r["i"] for r in op.not_in(ldf, "k", rdf, "v").collect())
    assert got == [i for i, x in enumerate(left) if py_not_in(x, right) is True]
    got_in = sorted(r["i"] for r in op.semi_in(ldf, "k", rdf, "v").collect())
    assert got_in == [i for i, x in enumerate(left) if x is not None and x in right]


def test_latest_snapshot_before_any_snapshot_matches_nothing(spark):
    snaps = spark.createDataFrame([(dt.date(2024, 3, 1), "a"), (dt.date(2024, 4, 1), "b")], "periodo date, v string")
    right = snaps.where(F.col("periodo") == op.latest_snapshot(snaps, "2020-01-01"))
    left = spark.createDataFrame([("a",), ("b",)], "v string")
    j = left.join(right.withColumnRenamed("v", "rv"), F.col("v") == F.col("rv"), "left")
    assert sorted((r["v"], r["periodo"]) for r in j.collect()) == [("a", None), ("b", None)]

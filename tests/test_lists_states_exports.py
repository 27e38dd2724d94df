"""Chunked lists, monthly sketches and states, reject tables, sharded CSV, written or planned key sets."""

from __future__ import annotations

import datetime as dt
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from claimweave import functions as cf
from claimweave import operators as op
from claimweave.operators.states import read_states, write_months
from claimweave.settings import session_conf
from claimweave.sources.csv_shards import read_csv_shards, verify_shards, write_csv_shards
from claimweave.sources.rejects import RejectedRows, split_rejects

D = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- chunked lists

@pytest.mark.parametrize("most", [1, 7, 1000])
def test_chunks_concatenate_to_the_whole_list(spark, most):
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, *[f"v{k}" for k in range(40)], "x" * 30])) for _ in range(3000)]
    data += [("nulls", None)] * 3 + [("one", "z")]
    df = spark.createDataFrame(data, "k string, v string")
    whole = {r["k"]: r["list"] for r in op.ordered_list(df, ["k"], "v", ",").collect()}
    got = defaultdict(dict)
    for r in op.list_chunks(df, ["k"], "v", ",", most, partitions=5).collect():
        got[r["k"]][r["chunk"]] = r["list"]
        assert r["list"] is None or r["list"].count(",") < most
    assert set(got) == set(whole)
    for k, pieces in got.items():
        assert sorted(pieces) == list(range(len(pieces)))
        assert whole[k] == (None if pieces[0] is None else ",".join(pieces[i] for i in range(len(pieces))))
    assert op.list_chunks(df.where("false"), ["k"], "v").collect() == []


def test_a_hot_group_of_different_values_is_spread(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    got = op.list_chunks(df, ["k"], "v", most=1000, partitions=8)
    assert got.count() == 40 and got.agg(F.max(F.size(F.split("list", ",")))).first()[0] == 1000
    layout = [p for p in os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/claimweave") if p.startswith("list_layout")]
    assert layout  # written once, by several tasks
    parts = [f for p in layout for f in os.listdir(f"{spark.conf.get('spark.checkpoint.dir')}/claimweave/{p}") if f.endswith(".parquet")]
    assert len(parts) >= 8


# ---------------------------------------------------------------- sketches

def test_merged_sketches_are_within_the_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.make_date(F.lit(2024), (F.col("id") % 12 + 1).cast("int"), F.lit(1)).alias("m"),
                                     (F.col("id") % 70_001).alias("v"))
    df = df.union(spark.createDataFrame([(9, D(2024, 1, 1), None), (8, D(2024, 1, 1), 5)], "g long, m date, v long"))
    sketches = op.monthly_sketches(df, ["g"], "m", "v").cache()
    exact = {r["g"]: r["n"] for r in op.count_distinct_by(df, ["g"], "v", "n").collect()}
    about = {r["g"]: r["n"] for r in op.merged_distinct(sketches, ["g"]).collect()}
    assert set(about) == set(exact) and exact[9] == about[9] == 0 and about[8] == 1
    assert all(abs(about[g] - n) <= op.error_bound() * n for g, n in exact.items())
    # Sketches of months merged in two steps, and a month given twice, count the same.
    twice = op.merged_distinct(sketches.union(sketches.where("month(m) < 4")), ["g"])
    assert {r["g"]: r["n"] for r in twice.collect()} == about
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 8192 and op.error_bound(14) < op.error_bound(10)
    assert op.merged_distinct(sketches.where("false"), ["g"]).collect() == []


# ---------------------------------------------------------------- states

def events(spark, n=3000):
    rng = random.Random(2)
    data = []
    for k in range(n):
        day = D(2024, rng.randrange(1, 7), rng.randrange(1, 28))
        data.append((rng.randrange(400), rng.choice("abc"), day, day.replace(day=1), rng.choice([None, f"c{rng.randrange(900)}"])))
    return spark.createDataFrame(data, "member int, dx string, day date, periodo date, claim string")


def test_states_of_monthly_runs_equal_the_full_run(spark, tmp_path):
    df, keys, path = events(spark), ["member", "dx"], str(tmp_path / "s")
    every = [D(2024, m, 1) for m in range(1, 7)]
    for m in every:
        write_months(df.where(F.col("periodo") == F.lit(m)), path, m, keys, "day", "claim")
    full = rows(op.event_state(df, keys, "day", "claim"))
    assert rows(read_states(spark, path, keys)) == full
    twice = op.repeat_flag(df, keys, "claim", 2).select(*keys)
    assert rows(op.repeated(read_states(spark, path, keys)).select(*keys)) == rows(twice) and twice.count() > 0
    # A month that is corrected and run again counts as it is now; months arrive in any order.
    fixed = df.where("periodo = date'2024-03-01' and member % 2 = 0")
    write_months(fixed, path, D(2024, 3, 1), keys, "day", "claim")
    now = df.where("periodo <> date'2024-03-01' or member % 2 = 0")
    assert rows(read_states(spark, path, keys)) == rows(op.event_state(now, keys, "day", "claim"))


# ---------------------------------------------------------------- rejects

def test_rejected_rows_are_named_before_the_strict_form_fails(spark, tmp_path):
    df = spark.createDataFrame([(1, "20240131", "5"), (2, "20240132", "x"), (3, None, "7"), (4, "", None), (5, "2024013", "1")],
                               "id int, day string, amount string")
    parsed = {"day": F.try_to_date("day", "yyyyMMdd"), "amount": F.expr("try_cast(amount AS INT)")}
    path = str(tmp_path / "r")
    with pytest.raises(RejectedRows, match="3 rows rejected .day: 3, amount: 1.") as e:
        split_rejects(df, parsed, path)
    assert e.value.counts == {"day": 3, "amount": 1} and e.value.rows == 3
    bad = {r["id"]: (r["day"], r["reasons"]) for r in spark.read.parquet(path).collect()}
    assert bad == {2: ("20240132", ["day: 20240132", "amount: x"]), 4: ("", ["day: "]), 5: ("2024013", ["day: 2024013"])}
    kept = split_rejects(df, parsed, path, strict=False)
    assert rows(kept) == [(1, D(2024, 1, 31), 5), (3, None, 7)] and kept.columns == df.columns
    assert rows(split_rejects(df.where("id in (1, 3)"), parsed, path)) == [(1, D(2024, 1, 31), 5), (3, None, 7)]
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(Exception):
        df.select(cf.strict_date("day", "yyyyMMdd")).collect()


# ---------------------------------------------------------------- CSV shards

TEXTS = ["", None, "a\nb", "a\\nb", "\\", "\\\\n", "\r\n", "x;\"y\"\\", " \\N \n", "\\\n\\r", "é\n東京", "plain", "\\\\", "end\\"]


def test_shards_read_back_value_for_value(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(k, TEXTS[k % len(TEXTS)], 1.5 * k) for k in range(1000)], "id int, t string, x double").repartition(3)
    write_csv_shards(df, path, most_rows=60)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) >= 1000 / 60 and verify_shards(spark, path) == len(files)
    with open(f"{path}/{files[0]}") as f:
        assert len(f.read().splitlines()) <= 61
    assert rows(read_csv_shards(spark, path, df.schema)) == rows(df)
    empty = str(tmp_path / "e")
    write_csv_shards(df.where("false"), empty)
    assert read_csv_shards(spark, empty, df.schema).count() == 0


def test_a_shard_splits_on_read(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(20_000).select("id", F.concat(F.lit("line\nbreak "), F.col("id").cast("string")).alias("t")).coalesce(1)
    write_csv_shards(df, path)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "100000", "spark.sql.files.openCostInBytes": "0"}):
        back = read_csv_shards(spark, path, df.schema)
        assert back.select(F.spark_partition_id()).distinct().count() >= 4
        assert rows(back) == rows(df)


def test_shards_that_differ_from_the_manifest_are_named(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(300).select("id", F.col("id").cast("string").alias("t")).repartition(3)

    def broken(change):
        write_csv_shards(df, path)
        own = sorted(f for f in os.listdir(path) if f.endswith(".csv"))[0]
        for crc in os.listdir(path):
            if crc.endswith(".crc"):
                os.remove(f"{path}/{crc}")
        change(f"{path}/{own}")
        with pytest.raises(ValueError, match="differ from the manifest"):
            read_csv_shards(spark, path, df.schema)

    def rewrite(f):
        with open(f) as g:
            text = g.read()
        with open(f, "w") as g:
            g.write(text.replace("1", "2", 1))

    broken(os.remove)
    broken(rewrite)
    broken(lambda f: os.link(f, f.replace("part-", "part-9")))


# ---------------------------------------------------------------- NOT IN

@pytest.mark.parametrize("keys", [[], [None], [1, 2], [1, None, 2, 2]])
def test_not_in_is_the_same_written_or_planned_twice(spark, keys):
    df = spark.createDataFrame([(k,) for k in (1, 2, 3, None, 3)], "k int")
    ks = spark.createDataFrame([(k,) for k in keys], "x int")
    df.createOrReplaceTempView("not_in_left")
    ks.createOrReplaceTempView("not_in_right")
    want = rows(spark.sql("SELECT * FROM not_in_left WHERE k NOT IN (SELECT x FROM not_in_right)"))
    assert rows(op.not_in(df, "k", ks, "x", written=False)) == rows(op.not_in(df, "k", ks, "x")) == want

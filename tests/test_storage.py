"""Stored layouts: bucketed feeds, months replaced, filtered and salted joins, scratch removal."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimweave import operators as op
from claimweave.operators.filtered import bits_for, bloom_settings, key_table, semi_join_filtered
from claimweave.plans import encounters as enc
from claimweave.plans import jobs, run_job
from claimweave.plans import service_lines as svc
from claimweave.plans.extract_queries import SERVICE_LINES
from claimweave.plans.storage_queries import feed_lines
from claimweave.settings import CO_LOCATED, session_conf
from claimweave.sources import feed_store, sinks, standin
from claimweave.sources.months import latest_month, months, read_latest, replace_months, replace_months_of_table
from claimweave.sources.tables import Tables
from fixtures import SF_SMALL

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
D = dt.date


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shuffled(df) -> int:
    """Rows written to shuffles when ``df`` is run (AQE off: one plan)."""
    with session_conf(df.sparkSession, {"spark.sql.adaptive.enabled": "false"}):
        again = df.select("*")
        again.collect()
        total, left = 0, [again._jdf.queryExecution().executedPlan()]
        while left:
            node = left.pop()
            if node.nodeName() == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            left += [children.apply(k) for k in range(children.size())]
        return total


@pytest.fixture
def stored(spark, tmp_path):
    prefix = f"t_{uuid.uuid4().hex[:8]}"
    feeds = standin.feeds(Tables(spark, SF_SMALL), True)
    feed_store.store_feeds(feeds, prefix, 8, str(tmp_path))
    yield prefix, feeds
    feed_store.drop_feeds(spark, prefix, tuple(feeds))
    assert not any(t.name.startswith(prefix) for t in spark.catalog.listTables())
    assert os.listdir(tmp_path) == []


def test_stored_feeds_are_joined_in_place(spark, stored):
    prefix, feeds = stored
    own = feed_store.open_feeds(spark, prefix, ("M", "N"))
    with session_conf(spark, {**CO_LOCATED, **NO_BROADCAST}):
        for name in own:
            plan = plan_of(feed_lines({name: own[name]}, "P"))
            assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount" in plan
        assert "Exchange" in plan_of(feed_lines(feeds, "P"))
        got = rows(feed_lines(own, "P"))
    assert got == rows(feed_lines(feeds, "P")) and got


def test_each_bucket_is_one_file_or_as_many_as_asked(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") % 97).alias("nro_proceso"), F.col("id").alias("x"))
    for pieces in (1, 3):
        feed_store.write_bucketed(df, "bucketed_once", "nro_proceso", 4, str(tmp_path / "b"), pieces)
        files = [f for f in os.listdir(tmp_path / "b") if f.endswith(".parquet")]
        assert 4 <= len(files) <= 4 * pieces and (pieces == 1 or len(files) > 4)
        sizes = feed_store.bucket_bytes(spark, str(tmp_path / "b"))
        assert set(sizes) == {0, 1, 2, 3} and spark.table("bucketed_once").count() == 4000
        one = spark.table("bucketed_once").where("nro_proceso = 5")
        assert one.count() == df.where("nro_proceso = 5").count()
    sinks.drop_table(spark, "bucketed_once")


def test_an_outsized_bucket_is_read_as_files(spark, tmp_path):
    # A third of the rows is one batch.
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("nro_proceso"), F.rand(1).alias("x"))
    feed_store.write_bucketed(df, "bucketed_hot", "nro_proceso", 16, str(tmp_path / "h"), pieces=4)
    even = feed_store.open_table(spark, "bucketed_hot")
    hot = feed_store.open_table(spark, "bucketed_hot", most=2.0, least=1000)
    assert rows(even) == rows(hot)
    with session_conf(spark, {**CO_LOCATED, **NO_BROADCAST}):
        assert "Exchange" not in plan_of(even.groupBy("nro_proceso").count())
        assert "Exchange" in plan_of(hot.groupBy("nro_proceso").count())
    sinks.drop_table(spark, "bucketed_hot")
    assert not feed_store.uneven({}, 4) and not feed_store.uneven({0: 100}, 4, least=100)
    assert feed_store.uneven({0: 101}, 5, least=100)


def test_service_lines_on_stored_feeds(spark, stored):
    prefix, feeds = stored
    inp = standin.service_lines_inputs(Tables(spark, SF_SMALL))
    plain = rows(svc.service_lines_extract(inp, SERVICE_LINES))
    own = replace(inp, feeds=feed_store.open_feeds(spark, prefix, ("M", "N")))
    with session_conf(spark, CO_LOCATED):
        assert rows(svc.service_lines_extract(own, replace(SERVICE_LINES, filter_keys=True))) == plain


def test_bloom_filter_stands_before_the_feed_shuffle(spark):
    t = Tables(spark, SF_SMALL)
    feed = standin.feeds(t, False)["M"]
    feed = replace(feed, encounter=sinks.stage(feed.encounter, "encounters"))
    e = enc.feed_encounters(feed, "P").withColumn("ID", enc.encounter_claim_key())
    ids = t.t("orders").where("o_orderkey % 40 = 0").select(standin.claim_id().alias("k"))
    want = rows(op.semi_in(e, "ID", ids, "k"))
    keys = key_table(ids, "k")
    n = keys.count()
    with session_conf(spark, {**NO_BROADCAST, **bloom_settings(n)}):
        own = semi_join_filtered(e, "ID", keys)
        plan = own._jdf.queryExecution().optimizedPlan().toString()
        feed_side = plan[plan.index("might_contain"):]
        assert "codigo_cie101" in feed_side and "__key" not in feed_side.split("Relation")[0].split("might_contain")[0]
        assert rows(own) == want and want
        few = shuffled(own)
    with session_conf(spark, NO_BROADCAST):
        many = shuffled(op.semi_in(e, "ID", keys, "__key"))
    assert few < many / 2
    assert rows(op.semi_in_filtered(e, "ID", ids, "k")) == want


def test_each_feed_has_one_filter_and_the_feed_joins_none(spark, stored):
    """Each filter goes through the driver, so a plan may hold one only: that of the claim keys."""
    prefix, _ = stored
    filters = {}

    def stage(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters.setdefault(name, []).append((plan.count("bloom_filter_agg("), plan.count("bloom_filter_agg(xxhash64(__key")))
        return sinks.stage(df, name)

    own = replace(standin.service_lines_inputs(Tables(spark, SF_SMALL)), feeds=feed_store.open_feeds(spark, prefix, ("M", "N")))
    with session_conf(spark, {**CO_LOCATED, **NO_BROADCAST}):
        svc.service_lines_extract(own, replace(SERVICE_LINES, filter_keys=True), stage)
    assert filters.pop("service_filtered_encounters") == [(1, 1), (1, 1)]
    assert all(f == [(0, 0)] * len(f) for f in filters.values())


def test_a_filter_is_bounded_and_lets_more_pass(spark):
    bits, on = "spark.sql.optimizer.runtime.bloomFilter.numBits", "spark.sql.optimizer.runtime.bloomFilter.enabled"
    assert bloom_settings(14_000_000)[bits] == str(1 << 26) and bloom_settings(14_000_000)[on] == "true"
    assert bloom_settings(40_000_000)[on] == "false"


def test_bloom_settings_follow_the_number_of_keys(spark):
    assert bits_for(0) == 64 and 7 < bits_for(10 ** 6) / 10 ** 6 < 8
    assert bloom_settings(10 ** 9)["spark.sql.optimizer.runtime.bloomFilter.enabled"] == "false"
    df = spark.createDataFrame([("a",), ("",), (None,), ("b",)], "k string")
    for keys, want in (([("a",), (None,), ("a",)], ["a"]), ([("",)], [""]), ([], []), ([(None,)], [])):
        got = op.semi_in_filtered(df, "k", spark.createDataFrame(keys, "x string"), "x")
        assert [r["k"] for r in got.collect()] == want


def monthly(spark, path):
    df = spark.range(60).select("id", F.make_date(F.lit(2024), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("periodo"))
    df.write.partitionBy("periodo").parquet(path)
    return df


def test_a_replaced_month_leaves_the_others_files(spark, tmp_path):
    path = str(tmp_path / "t")
    monthly(spark, path)
    files = lambda m: {f: os.stat(f"{path}/periodo={m}/{f}").st_mtime_ns for f in os.listdir(f"{path}/periodo={m}")}
    before = {m: files(m) for m in ("2024-01-01", "2024-02-01", "2024-03-01")}
    new = spark.createDataFrame([(1000, D(2024, 2, 1)), (1001, D(2024, 2, 1))], "id long, periodo date")
    for _ in range(2):  # a rerun gives the same table
        assert replace_months(new, path, D(2024, 2, 1)) == {D(2024, 2, 1): 2}
        assert files("2024-01-01") == before["2024-01-01"] and files("2024-03-01") == before["2024-03-01"]
        got = spark.read.parquet(path)
        assert sorted(r["id"] for r in got.where("periodo = date'2024-02-01'").collect()) == [1000, 1001]
        assert got.count() == 42
    # A new month, an emptied one, and a table that isn't there yet.
    assert replace_months(new.withColumn("periodo", F.lit(D(2024, 4, 1))), path, ["2024-04-01", "2024-01-01"]) == {
        D(2024, 1, 1): 0, D(2024, 4, 1): 2}
    assert months(spark, path) == [D(2024, 2, 1), D(2024, 3, 1), D(2024, 4, 1)]
    replace_months(new, str(tmp_path / "fresh"), "2024-02-01")
    assert spark.read.parquet(str(tmp_path / "fresh")).count() == 2
    assert sorted(os.listdir(tmp_path)) == ["fresh", "t"]


def test_a_row_of_another_month_fails_and_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    before = rows(monthly(spark, path))
    for bad in (D(2024, 3, 1), None):
        new = spark.createDataFrame([(1, D(2024, 2, 1)), (2, bad)], "id long, periodo date")
        with pytest.raises(Exception, match="not among the months replaced"):
            replace_months(new, path, "2024-02-01")
    assert rows(spark.read.parquet(path)) == before and os.listdir(tmp_path) == ["t"]


def test_a_swap_that_fails_restores_the_month(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    before = rows(monthly(spark, path))
    from claimweave.sources import months as m

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if "__months_" in a.toString() else self.fs.rename(a, b)

    real = m._files
    monkeypatch.setattr(m, "_files", lambda spark, p: (Broken(real(spark, p)[0]), real(spark, p)[1]))
    new = spark.createDataFrame([(1, D(2024, 2, 1))], "id long, periodo date")
    with pytest.raises(OSError, match="as before"):
        replace_months(new, path, "2024-02-01")
    assert rows(spark.read.parquet(path)) == before


def test_months_of_a_catalog_table(spark):
    table = f"months_{uuid.uuid4().hex[:8]}"
    one = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 2, 1), 2)], "periodo date, id long")
    replace_months_of_table(one, table, ["2024-01-01", "2024-02-01"])
    two = spark.createDataFrame([(5, D(2024, 2, 1))], "id long, periodo date")
    for _ in range(2):
        assert replace_months_of_table(two, table, "2024-02-01") == {D(2024, 2, 1): 1}
        assert rows(spark.table(table).select("periodo", "id")) == [(D(2024, 1, 1), 1), (D(2024, 2, 1), 5)]
    assert replace_months_of_table(two.where("false"), table, "2024-01-01") == {D(2024, 1, 1): 0}
    assert months(spark, table) == [D(2024, 2, 1)] and latest_month(spark, table, "2024-01-31") is None
    assert rows(read_latest(spark, table, "2024-12-31").select("id")) == [(5,)]
    assert read_latest(spark, table, "2023-12-31").count() == 0
    sinks.drop_table(spark, table)


def test_the_as_of_month_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    monthly(spark, path)
    assert latest_month(spark, path, "2024-02-20") == D(2024, 2, 1)
    got = read_latest(spark, path, "2024-02-20")
    plan = got._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(periodo" in plan.toString() and "2024-02-01" in plan.toString()
    assert got.count() == 20 and "number of partitions" not in plan.toString()
    # The subquery form prunes too: its value is a partition filter of the scan.
    df = spark.read.parquet(path)
    pruned = df.where(F.col("periodo") == op.latest_snapshot(df, "2024-02-20"))
    assert "PartitionFilters: [isnotnull(periodo" in plan_of(pruned) and "Subquery" in plan_of(pruned) and pruned.count() == 20
    scanned = spark.sparkContext._jvm.java.util.ArrayList()
    assert latest_month(spark, str(tmp_path / "none"), "2024-02-20") is None and scanned.size() == 0


def hot(spark, n=30000):
    """A third of the rows is one key, another eighth a second one, some are NULL."""
    k = F.col("id")
    key = F.when(k % 3 == 0, 7).when(k % 8 == 1, 9).when(k % 50 == 2, None).otherwise(k % 997 + 100)
    return spark.range(n).select("id", key.cast("long").alias("key"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_plain_one(spark, how):
    left = hot(spark)
    right = spark.range(0, 1200).where("id % 5 <> 3").select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    right = right.union(right.where("k in (7, 200)"))  # two partners of a heavy and of an ordinary key
    plain = rows(left.join(right, F.col("key") == F.col("k"), how))
    assert rows(op.salted_join(left, right, "key", "k", how)) == plain
    assert rows(op.salted_join(left, right, "key", "k", how, salts={})) == plain
    assert rows(op.salted_join(left.limit(0), right, "key", "k", how)) == []


def test_heavy_keys_are_found(spark):
    salts = op.heavy_keys(hot(spark), "key", 8)
    assert {7, 9} <= set(salts) and salts[7] > salts[9] > 1 and len(salts) < 80
    assert op.heavy_keys(hot(spark).where("false"), "key", 8) == {}
    words = hot(spark).select(F.concat(F.lit("m"), F.col("key").cast("string")).alias("w"))
    assert "m7" in op.heavy_keys(words, F.col("w"), 8)


def test_no_task_of_a_salted_join_reads_twice_the_median(spark):
    left, right = hot(spark, 200_000), spark.range(0, 1200).select(F.col("id").alias("k"))
    off = {**NO_BROADCAST, "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}

    def largest(df):
        n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return n[-1] / n[len(n) // 2]

    with session_conf(spark, off):
        # The counts by partition come after the join, whose rows stay where it put them.
        assert largest(left.join(right, F.col("key") == F.col("k"), "left")) > 4
        assert largest(op.salted_join(left, right, "key", "k", "left")) < 2


def test_members_with_a_heavy_member(spark):
    """One member on a third of the premium rows, split over his tasks; the rows are those of plain joins."""
    from claimweave.plans import members as mem
    from claimweave.plans.extract_queries import MEMBERS

    inp = standin.members_inputs(Tables(spark, SF_SMALL))
    k = F.pmod(F.xxhash64("id_unidad_asegurable", "periodo_bitacora"), F.lit(3))
    hot = inp.premiums.withColumn("id_persona_afiliado", F.when(k == 0, "AX-1").otherwise(F.col("id_persona_afiliado")))
    inp = replace(inp, premiums=sinks.stage(hot, "premiums"))
    assert "AX-1" in op.heavy_keys(inp.premiums, "id_persona_afiliado", 8)
    plain = rows(mem.members_extract(inp, MEMBERS))
    assert rows(mem.members_extract(inp, replace(MEMBERS, salt_heavy=True))) == plain and plain


def test_staged_tables_of_a_job_are_removed(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    inp = standin.encounters_inputs(Tables(spark, SF_SMALL))
    from claimweave.plans.extract_queries import ENCOUNTERS
    before = set(os.listdir(f"{root}/claimweave")) if os.path.isdir(f"{root}/claimweave") else set()
    out = jobs.run_encounters(inp, ENCOUNTERS, str(tmp_path / "out"))
    assert out.count() > 0
    assert set(os.listdir(f"{root}/claimweave")) == before
    with pytest.raises(ValueError), sinks.job_scratch(spark):
        sinks.stage(spark.range(3), "x")
        raise ValueError
    assert set(os.listdir(f"{root}/claimweave")) == before


def test_a_table_swap_that_fails_keeps_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3).toDF("id"), path)
    with pytest.raises(OSError):
        sinks._swap(spark, path, str(tmp_path / "not_there"), str(tmp_path / "old"))
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]
    table = f"swap_{uuid.uuid4().hex[:8]}"
    sinks.replace_table(spark.range(3).toDF("id"), table)
    real = spark.sql

    def broken(text, *a, **kw):
        if "__new_" in text and "RENAME" in text:
            raise RuntimeError("lost")
        return real(text, *a, **kw)

    monkeypatch.setattr(type(spark), "sql", lambda self, *a, **kw: broken(*a, **kw))
    with pytest.raises(RuntimeError):
        sinks.replace_table(spark.range(9).toDF("id"), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(table)] == [table]
    sinks.drop_table(spark, table)


def test_monthly_runs_replace_their_month(spark, tmp_path):
    from claimweave.plans.extract_queries import ENCOUNTERS

    inp = standin.encounters_inputs(Tables(spark, SF_SMALL))
    where = {"feeds": {f: {} for f in inp.feeds}}
    for name in ("claims", "authorisations"):
        where[name] = f"{tmp_path}/{name}"
        getattr(inp, name).write.parquet(where[name])
    for feed, tables in inp.feeds.items():
        for name in ("header", "invoice", "encounter"):
            where["feeds"][feed][name] = f"{tmp_path}/{feed}_{name}"
            getattr(tables, name).write.parquet(where["feeds"][feed][name])
    table = f"monthly_{uuid.uuid4().hex[:8]}"
    whole = run_job.run(spark, "encounters", where, f"{table}_whole", params=ENCOUNTERS)
    want = rows(whole)
    for _ in range(2):
        got = run_job.run(spark, "encounters", where, table, params=ENCOUNTERS, monthly=True)
        assert rows(got.select(*whole.columns)) == want
    assert months(spark, table) == [ENCOUNTERS.as_of.replace(day=1)] and spark.table(table).count() == len(want) > 0
    for t in (table, f"{table}_whole"):
        sinks.drop_table(spark, t)


def test_latest_site_names(spark):
    data = [("P", "1", "old", D(2024, 1, 1)), ("P", "1", "new", D(2024, 2, 1)), ("P", "1", "also new", D(2024, 2, 1)),
            ("P", "1", None, D(2024, 3, 1)), ("P", "2", None, D(2024, 1, 1)), ("Q", None, "x", D(2024, 1, 1)), (None, "1", "y", D(2024, 1, 1))]
    claims = spark.createDataFrame(data, "id_persona_proveedor_siniestro string, cod_sede_proveedor_siniestro string, "
                                         "nom_sede_proveedor_siniestro string, periodo date")
    assert rows(enc.provider_sites(claims, latest=True)) == [("P-1", "new"), ("P-2", None), (None, "x")]
    assert len(rows(enc.provider_sites(claims))) == 6
    assert rows(enc.provider_sites(claims, D(2024, 1, 1))) == [("P-1", "old"), ("P-2", None), (None, "x")]

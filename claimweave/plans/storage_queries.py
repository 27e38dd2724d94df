"""Queries over stored layouts: bucketed feeds, tables by month, filtered and salted joins.

Each writes what it reads from the whole test tables, as a monthly job would, and
returns rows that a plain query over the same tables gives too.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave import functions as cf
from claimweave import operators as op
from claimweave.plans import encounters as enc
from claimweave.plans import members as mem
from claimweave.plans import service_lines as svc
from claimweave.operators.states import read_states, write_months
from claimweave.plans import catalog  # noqa: F401  whose export query's SQL is used again
from claimweave.plans.extract_queries import (ENCOUNTERS, ENCOUNTERS_SQL, MEMBERS, MEMBERS_SQL, SERVICE_LINES,
                                                 SERVICE_LINES_SQL, rounded)
from claimweave.plans.registry import REGISTRY, query
from claimweave.settings import CO_LOCATED, READ_BY_BUCKET, session_conf
from claimweave.sources import standin
from claimweave.sources.csv_shards import read_csv_shards, write_csv_shards
from claimweave.sources.feed_store import buckets_for, drop_feeds, open_feeds, store_feeds, write_bucketed
from claimweave.sources.months import read_latest, replace_months
from claimweave.sources.rejects import split_rejects
from claimweave.sources.schemas import ENCOUNTER_KEY
from claimweave.sources.sinks import drop_table, scratch_path, stage
from claimweave.sources.tables import Tables

#: At least; more with the lines' files.
BUCKETS = 16


def _stored(t: Tables) -> tuple[str, dict[str, enc.FeedTables]]:
    """The stand-in feeds as bucketed tables; their prefix, and the tables.

    All of them derive from orders and lines. These are dealt by order key, which is the
    batch number, once; their joins and the feeds' rows then stay in their bucket.
    """
    prefix, path = f"feeds_{uuid.uuid4().hex[:12]}", scratch_path(t.spark, "feeds")
    buckets = buckets_for(t.spark, t.path("lineitem"), BUCKETS)
    sources = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    for name, key in sources.items():
        write_bucketed(t.t(name), f"{prefix}_{name}", key, buckets, f"{path}/{name}")
    with session_conf(t.spark, READ_BY_BUCKET):
        store_feeds(standin.feeds(t.stored_as({name: f"{prefix}_{name}" for name in sources}), True), prefix, buckets,
                    path, dealt=True)
    for name in sources:
        drop_table(t.spark, f"{prefix}_{name}")
    return prefix, open_feeds(t.spark, prefix, tuple(standin.FEED_STATUS))


def feed_lines(feeds: dict[str, enc.FeedTables], status: str) -> DataFrame:
    """Header x invoice x encounter x line of each feed, both kinds of line."""
    out = []
    for name, feed in feeds.items():
        own = enc.feed_encounters(feed, status).select(*ENCOUNTER_KEY, "cod_proveedor")
        for kind, lines, amount in (("procedure", feed.procedure, "monto_cubierto_servicio"),
                                    ("drug", feed.drug, "monto_cubierto_producto")):
            j = own.join(lines.select(*ENCOUNTER_KEY, F.col(amount).alias("amount")), ENCOUNTER_KEY)
            out.append(j.select(F.lit(name).alias("feed"), F.lit(kind).alias("line"), "nro_proceso",
                                "correlativo_atencion", "cod_proveedor", cf.to_double("amount").alias("amount")))
    return op.union_all(*out)


@query("co_located_feeds", "D5 D6 M2.17 M3.8 M3.9 M3.10", """
SELECT CASE l.l_linestatus WHEN 'F' THEN 'M' ELSE 'N' END AS feed, line, o_orderkey AS nro_proceso,
       CAST(l.l_linenumber AS VARCHAR) AS correlativo_atencion, o_custkey % 40 AS cod_proveedor,
       l.l_extendedprice AS amount
FROM lineitem encounter
JOIN lineitem l ON encounter.l_orderkey = l.l_orderkey AND encounter.l_linenumber = l.l_linenumber
               AND encounter.l_linestatus = l.l_linestatus
JOIN orders ON l.l_orderkey = o_orderkey
JOIN (VALUES ('procedure'), ('drug')) AS kinds(line) ON line = 'procedure' OR l.l_quantity > 25
WHERE o_orderstatus <> 'P' AND (o_orderpriority <> '3-MEDIUM' OR o_orderstatus <> 'O')
""")
def co_located_feeds(t: Tables) -> DataFrame:
    """The feeds joined by bucket: no feed table is exchanged."""
    prefix, feeds = _stored(t)
    with session_conf(t.spark, CO_LOCATED):
        out = stage(feed_lines(feeds, "P"), "feed_lines")
    drop_feeds(t.spark, prefix, tuple(feeds))
    return out


@query("service_lines_stored_feeds", "M3.1-M3.13 on bucketed feeds, keys filtered", SERVICE_LINES_SQL)
def service_lines_stored_feeds(t: Tables) -> DataFrame:
    prefix, feeds = _stored(t)
    inputs = replace(standin.service_lines_inputs(t), feeds=feeds)
    with session_conf(t.spark, CO_LOCATED):
        totals = svc.service_lines_extract(inputs, replace(SERVICE_LINES, filter_keys=True))
        # Attentions and lines are written: the feeds make room for the totals.
        drop_feeds(t.spark, prefix, tuple(feeds))
        return rounded(stage(totals, "service_lines"))


REPLACED = ("1996-03-01", "1998-02-01")
_MONTH_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def _by_month(t: Tables) -> DataFrame:
    return t.t("orders").select("o_orderkey", "o_custkey", "o_totalprice", cf.month_start("o_orderdate").alias("periodo"))


def _monthly_orders(t: Tables) -> str:
    """The orders as a table by month; its path."""
    path = scratch_path(t.spark, "orders_by_month")
    _by_month(t).repartition("periodo").write.partitionBy("periodo").parquet(path)
    return path


@query("month_overwrite_readback", "A2 A6 A7 A9", f"""
SELECT o_orderkey, o_custkey, periodo,
       CASE WHEN periodo IN (DATE '{REPLACED[0]}', DATE '{REPLACED[1]}') THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
FROM (SELECT *, {_MONTH_SQL} AS periodo FROM orders)
WHERE periodo <> DATE '{REPLACED[1]}' OR o_orderkey % 2 = 0
""")
def month_overwrite_readback(t: Tables) -> DataFrame:
    """A table by month in which two months are replaced, one by fewer rows; the second run changes nothing."""
    path = _monthly_orders(t)
    new = _by_month(t).where(F.col("periodo").cast("string").isin(*REPLACED)).where(
        (F.col("periodo").cast("string") != REPLACED[1]) | (F.col("o_orderkey") % 2 == 0)).withColumn(
        "o_totalprice", -F.col("o_totalprice"))
    for _ in range(2):
        replace_months(new, path, list(REPLACED))
    return t.spark.read.parquet(path)


@query("latest_month_scan", "A4 E15 S26", f"""
SELECT c_custkey, c_name, o_orderkey, o_totalprice, periodo
FROM customer LEFT JOIN (SELECT *, {_MONTH_SQL} AS periodo FROM orders) o ON c_custkey = o_custkey
 AND periodo = (SELECT max({_MONTH_SQL}) FROM orders WHERE {_MONTH_SQL} <= DATE '1998-06-15')
""")
def latest_month_scan(t: Tables) -> DataFrame:
    """The as-of month from the table's partitions: one month is read, no row for the maximum."""
    latest = read_latest(t.spark, _monthly_orders(t), "1998-06-15")
    return t.t("customer").join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "o_orderkey", "o_totalprice", "periodo")


@query("semi_join_filtered", "D11", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def semi_join_filtered(t: Tables) -> DataFrame:
    urgent = t.t("orders").where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    found = op.semi_in_filtered(t.t("lineitem"), "l_orderkey", urgent, "o_orderkey")
    return found.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("left_join_heavy_keys", "D1 M1.15", """
SELECT l_orderkey, l_linenumber, key, s_name
FROM (SELECT *, CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber = 3 THEN NULL ELSE l_suppkey END AS key FROM lineitem)
LEFT JOIN supplier ON key = s_suppkey
""")
def left_join_heavy_keys(t: Tables) -> DataFrame:
    """One supplier on more than a third of the lines."""
    n = F.col("l_linenumber")
    key = F.when(n <= 2, F.lit(1)).when(n != 3, F.col("l_suppkey"))
    li = t.t("lineitem").select("l_orderkey", "l_linenumber", key.cast(t.t("lineitem").schema["l_suppkey"].dataType).alias("key"))
    j = op.salted_join(li, t.t("supplier").select("s_suppkey", "s_name"), "key", "s_suppkey")
    return j.select("l_orderkey", "l_linenumber", "key", "s_name")


@query("members_extract_salted", "M1.15 with heavy members", MEMBERS_SQL)
def members_extract_salted(t: Tables) -> DataFrame:
    return rounded(mem.members_extract(standin.members_inputs(t), replace(MEMBERS, salt_heavy=True)))


# ---------------------------------------------------------------- lists, counts, states

@query("string_list_chunks", "E9 E10", """
SELECT l_returnflag, (rn - 1) // 500 AS chunk, string_agg(v, ',' ORDER BY v) AS list
FROM (SELECT l_returnflag, CAST(l_partkey AS VARCHAR) AS v,
             row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_partkey AS VARCHAR)) AS rn FROM lineitem)
GROUP BY ALL
""")
def string_list_chunks(t: Tables) -> DataFrame:
    """Lists of three groups that hold all lines, 500 values a row."""
    return op.list_chunks(t.t("lineitem"), ["l_returnflag"], "l_partkey", most=500)


@query("distinct_by_month_sketches", "E3 E4", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_exact, true AS within_bound FROM lineitem GROUP BY l_returnflag
""")
def distinct_by_month_sketches(t: Tables) -> DataFrame:
    """Monthly sketches, written and merged; their count lies within the bound of the exact one."""
    li = t.t("lineitem").withColumn("periodo", cf.month_start("l_shipdate"))
    path = scratch_path(t.spark, "sketches")
    op.monthly_sketches(li, ["l_returnflag"], "periodo", "l_orderkey").write.partitionBy("periodo").parquet(path)
    about = op.merged_distinct(t.spark.read.parquet(path), ["l_returnflag"], "n_about")
    exact = op.count_distinct_by(li, ["l_returnflag"], "l_orderkey", "n_exact")
    j = exact.join(about, "l_returnflag")
    near = F.abs(F.col("n_about") - F.col("n_exact")) <= F.lit(op.error_bound()) * F.col("n_exact")
    return j.select("l_returnflag", "n_exact", near.alias("within_bound"))


@query("repeats_from_monthly_states", "M1.6 E5 E16", """
SELECT o_custkey, o_orderpriority, CAST(min(o_orderdate) AS DATE) AS first_date,
       min(o_orderkey) AS least_event, max(o_orderkey) AS greatest_event
FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderkey) >= 2
""")
def repeats_from_monthly_states(t: Tables) -> DataFrame:
    """Members with two claims of a kind, from states written in three runs, of which
    one replaces months that were there."""
    keys = ["o_custkey", "o_orderpriority"]
    o = t.t("orders").select(*keys, "o_orderkey", F.to_date("o_orderdate").alias("day"), cf.month_start("o_orderdate").alias("periodo"))
    path, of = scratch_path(t.spark, "states"), F.year("periodo")
    first_of = lambda *years: [f"{y}-{m:02}-01" for y in years for m in range(1, 13)]
    known = [r["y"] for r in o.select(of.alias("y")).distinct().collect()]
    older, newer = [y for y in known if y <= 1996], [y for y in known if y > 1996]
    for years in (older, newer, older[-1:]):
        write_months(o.where(of.isin(years)), path, first_of(*years), keys, "day", "o_orderkey")
    return op.repeated(read_states(t.spark, path, keys))


# ---------------------------------------------------------------- parsing, exports

_RAW_SQL = """CASE WHEN o_orderkey % 50 = 0 THEN strftime(o_orderdate, '%Y%m') || '32'
            WHEN o_orderkey % 50 = 1 THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END"""


@query("reject_table", "S16 S21", f"""
SELECT o_orderkey, raw, 'rejected' AS fate, NULL::DATE AS day FROM (SELECT o_orderkey, {_RAW_SQL} AS raw FROM orders)
WHERE raw IS NOT NULL AND try_strptime(raw, '%Y%m%d') IS NULL
UNION ALL
SELECT o_orderkey, NULL AS raw, 'kept' AS fate, CAST(try_strptime(raw, '%Y%m%d') AS DATE) AS day
FROM (SELECT o_orderkey, {_RAW_SQL} AS raw FROM orders) WHERE raw IS NULL OR try_strptime(raw, '%Y%m%d') IS NOT NULL
""")
def reject_table(t: Tables) -> DataFrame:
    """Texts of dates, parsed: the rows that can't be are written with the reason."""
    k = F.col("o_orderkey") % 50
    raw = F.when(k == 0, F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("32"))).when(
        k != 1, F.date_format("o_orderdate", "yyyyMMdd"))
    df, path = t.t("orders").select("o_orderkey", raw.alias("raw")), scratch_path(t.spark, "rejects")
    kept = split_rejects(df, {"raw": F.try_to_date("raw", "yyyyMMdd")}, path, strict=False)
    bad = t.spark.read.parquet(path).select("o_orderkey", "raw", F.lit("rejected").alias("fate"), F.lit(None).cast("date").alias("day"))
    return bad.union(kept.select("o_orderkey", F.lit(None).cast("string"), F.lit("kept"), F.col("raw")))


@query("csv_shards_readback", "A8 A9 G2", REGISTRY["csv_export_readback"].sql)
def csv_shards_readback(t: Tables) -> DataFrame:
    """The export of ``csv_export_readback`` in shards of 500 rows, checked against their manifest and read back."""
    k, priority = F.col("o_orderkey") % 7, F.col("o_orderpriority")
    note = (F.when(k == 0, None).when(k == 1, "").when(k == 2, F.concat(F.lit("  "), priority, F.lit(" ")))
            .when(k == 3, F.concat(F.lit('a;b"'), "o_orderstatus", F.lit('"')))
            .when(k == 4, F.concat(F.lit('\\"; '), priority)).when(k == 5, "\\N \nx").otherwise(priority))
    path = scratch_path(t.spark, "shards")
    write_csv_shards(t.t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", note.alias("note")), path, most_rows=500)
    return read_csv_shards(t.spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                                          "o_orderdate TIMESTAMP_NTZ, note STRING")


# ---------------------------------------------------------------- arrays of several elements, sites of a month

def _several(t: Tables) -> DataFrame:
    """Orders with a stored-like array ``lines`` of 0 to 3 elements (NULL for some),
    each with an array ``refs`` of 0 to 2, built from the row's own columns."""
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("long"), n.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    line = lambda k: F.struct(k.alias("line"), (k * F.col("o_totalprice")).alias("amount"), F.transform(
        upto(k - 1), lambda r: r * 10 + k).alias("refs"))
    lines = F.transform(upto(F.col("o_orderkey") % 4), line)
    return t.t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, lines).alias("lines"))


_LINES_SQL = """SELECT o_orderkey, o_totalprice, unnest(range(1, o_orderkey % 4 + 1)) AS line FROM orders WHERE o_orderkey % 7 <> 0"""


@query("explode_several_levels", "D8 D9", f"""
WITH l AS ({_LINES_SQL}), r AS (SELECT o_orderkey, line, unnest(range(1, line)) * 10 + line AS ref FROM l)
SELECT o.o_orderkey, l.line, round(l.line * l.o_totalprice, 4) AS amount, r.ref
FROM orders o LEFT JOIN l ON o.o_orderkey = l.o_orderkey LEFT JOIN r ON l.o_orderkey = r.o_orderkey AND l.line = r.line
""")
def explode_several_levels(t: Tables) -> DataFrame:
    ex = op.explode_path(_several(t), [("lines", "l"), ("l.refs", "ref")])
    return ex.select("o_orderkey", F.col("l.line").alias("line"), F.round("l.amount", 4).alias("amount"), "ref")


@query("explode_several_filtered", "D10", f"""
SELECT o_orderkey, line, round(line * o_totalprice, 4) AS amount FROM ({_LINES_SQL}) WHERE line <> 2
""")
def explode_several_filtered(t: Tables) -> DataFrame:
    n = _several(t).withColumn("lines", op.keep_elements("lines", lambda x: x["line"] != 2))
    ex = op.explode_rows(n, "lines", "l", outer=False)
    return ex.select("o_orderkey", F.col("l.line").alias("line"), F.round("l.amount", 4).alias("amount"))


def _two_snapshots(t: Tables) -> DataFrame:
    """The stand-in claims, and an older snapshot in which the sites have other names."""
    now = standin.claims(t, enc.CLAIM_FIELDS)
    old = now.withColumns({"periodo": F.lit(OLDER), "nom_sede_proveedor_siniestro": F.concat(F.lit("ANTES "), "nom_sede_proveedor_siniestro")})
    return now.unionByName(old)


OLDER = standin.SNAPSHOT.replace(month=standin.SNAPSHOT.month - 1)
_SITES_SQL = """SELECT DISTINCT 'AX-' || (o_custkey % 40) || '-' || (o_orderkey % 2) AS id,
       'SEDE ' || (o_custkey % 40) || '-' || (o_orderkey % 2) AS name FROM orders WHERE o_orderstatus <> 'P'"""


@query("provider_sites_by_snapshot", "M2.18", f"""
SELECT 'older' AS label, id, 'ANTES ' || name AS name FROM ({_SITES_SQL})
UNION ALL SELECT 'all', id, 'ANTES ' || name FROM ({_SITES_SQL})
UNION ALL SELECT 'all', id, name FROM ({_SITES_SQL})
""")
def provider_sites_by_snapshot(t: Tables) -> DataFrame:
    claims = _two_snapshots(t)
    own = lambda label, df: df.select(F.lit(label).alias("label"), F.col("__sp_id").alias("id"),
                                      F.col("nom_sede_proveedor_siniestro").alias("name"))
    return op.union_all(own("older", enc.provider_sites(claims, OLDER)), own("all", enc.provider_sites(claims)))


@query("encounters_extract_two_snapshots", "M2.18 of one snapshot among two", ENCOUNTERS_SQL)
def encounters_extract_two_snapshots(t: Tables) -> DataFrame:
    """Names of the current snapshot only, though the claims hold an older one with others."""
    inputs = replace(standin.encounters_inputs(t), claims=_two_snapshots(t))
    return rounded(enc.encounters_extract(inputs, replace(ENCOUNTERS, site_snapshot=standin.SNAPSHOT)))


@query("provider_sites_latest", "M2.18", f"""
SELECT id, CASE WHEN id LIKE '%-1' THEN 'ANTES ' || name ELSE name END AS name FROM ({_SITES_SQL})
""")
def provider_sites_latest(t: Tables) -> DataFrame:
    """One name for each site over two snapshots; sites numbered 1 have claims in the older one only."""
    claims = _two_snapshots(t)
    own = claims.where((F.col("cod_sede_proveedor_siniestro") != "1") | (F.col("periodo") == F.lit(OLDER)))
    found = enc.provider_sites(own, latest=True)
    return found.select(F.col("__sp_id").alias("id"), F.col("nom_sede_proveedor_siniestro").alias("name"))


@query("encounters_extract_latest_sites", "M2.18 of the latest names", ENCOUNTERS_SQL)
def encounters_extract_latest_sites(t: Tables) -> DataFrame:
    inputs = replace(standin.encounters_inputs(t), claims=_two_snapshots(t))
    return rounded(enc.encounters_extract(inputs, replace(ENCOUNTERS, latest_sites=True)))

"""Operator queries on the driver's test tables.

Stand-ins: customer = member/person, orders = claim, lineitem = care event or
service line, part = procedure/drug master (``p_brand`` = diagnosis,
``p_type`` = risk group), supplier = provider, nation/region = place
dimensions, ``l_returnflag`` = coverage group, ``l_linestatus`` = feed M/N,
month of ``o_orderdate`` = snapshot ``periodo``.

Every query reads whole tables; filters are the operator under test, never
a device to shrink the input. Money-like doubles are rounded to 4 decimals:
the inputs have at most 2 decimals, so sums and products have at most 4 and
rounding removes only the order-dependent noise of floating-point addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave import functions as cf
from claimweave import operators as op
from claimweave.plans.registry import query
from claimweave.sources.sinks import read_csv, scratch_path, stage, write_csv, write_table
from claimweave.sources.tables import Tables


def _month(c: str = "o_orderdate"):
    return cf.month_start(c)


def nested_orders(t: Tables) -> DataFrame:
    """Order records with a line as ``lines: array<struct>`` (NULL without a line,
    empty for returned lines).

    Stand-in for a natively nested claim table, where the array is stored: here
    each record's array is built from its own columns, so its size is bounded.
    """
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    j = t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.select(*t.t("orders").columns, F.when(F.col("l_orderkey").isNotNull(), F.array(line)).alias("lines"))


def _r4(c):
    return F.round(c, 4)


# ---------------------------------------------------------------- 2.1 scans, sinks

@query("snapshot_scan", "A1 A2 C1 C2", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo
FROM orders
WHERE CAST(date_trunc('month', o_orderdate) AS DATE) = DATE '1998-10-01'
""")
def snapshot_scan(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                             "o_orderdate", _month().alias("periodo"))
    return op.snapshot(o, "1998-10-01")


AS_OF = "2001-07-15"


@query("current_month_scan", "A3 S26 S27", f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo
FROM orders
WHERE CAST(date_trunc('month', o_orderdate) AS DATE) = CAST(date_trunc('month', DATE '{AS_OF}') AS DATE)
""")
def current_month_scan(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", _month().alias("periodo"))
    return o.where(F.col("periodo") == op.current_month(AS_OF))


@query("latest_snapshot_lookup", "A4 E15 P1 P2 D3", """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c
LEFT JOIN orders o
  ON c.c_custkey = o.o_custkey AND o.o_orderpriority = '1-URGENT' AND o.o_orderstatus <> 'F'
 AND CAST(date_trunc('month', o.o_orderdate) AS DATE) = (
     SELECT max(CAST(date_trunc('month', o_orderdate) AS DATE)) FROM orders
     WHERE CAST(date_trunc('month', o_orderdate) AS DATE) <= DATE '1998-06-15')
""")
def latest_snapshot_lookup(t: Tables) -> DataFrame:
    snaps = t.t("orders").withColumn("periodo", _month())
    latest = op.latest_snapshot(snaps, "1998-06-15")
    right = (snaps.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "F")
                         & (F.col("periodo") == latest))
             .select("o_custkey", "o_orderkey", "o_totalprice"))
    return (t.t("customer").join(right, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "c_name", "o_orderkey", "o_totalprice"))


@query("twin_feed_union", "A5 H1 H3", """
SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'
UNION ALL
SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O'
""")
def twin_feed_union(t: Tables) -> DataFrame:
    li = t.t("lineitem")

    def build(feed: str) -> DataFrame:
        return li.where(F.col("l_linestatus") == feed).select("l_orderkey", "l_returnflag")

    return op.both_feeds(build, ("F", "O"), distinct_each=True)


_Q1_SQL = """
SELECT l_returnflag, l_linestatus,
       CAST(count(*) AS BIGINT) AS count_order,
       round(sum(l_quantity), 4) AS sum_qty,
       round(sum(l_extendedprice), 4) AS sum_base_price
FROM lineitem GROUP BY l_returnflag, l_linestatus
"""


def _q1(t: Tables) -> DataFrame:
    return (t.t("lineitem").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("count_order"),
                 _r4(F.sum("l_quantity")).alias("sum_qty"),
                 _r4(F.sum("l_extendedprice")).alias("sum_base_price")))


@query("write_replace_readback", "A6 A7 A9 P4", _Q1_SQL)
def write_replace_readback(t: Tables) -> DataFrame:
    """Write the summary twice into one path (the second write replaces the first), read back."""
    path = scratch_path(t.spark, "summary")
    df = _q1(t)
    write_table(df.where(F.lit(False)), path)   # truncate-equivalent first statement
    write_table(df, path)                       # create-or-replace
    return t.spark.read.parquet(path)


@query("csv_export_readback", "A8 G2 A9", r"""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || o_orderpriority || ' '
            WHEN 3 THEN 'a;b"' || o_orderstatus || '"' WHEN 4 THEN '\"; ' || o_orderpriority WHEN 5 THEN '\N ' || chr(10) || 'x'
            ELSE o_orderpriority END AS note
FROM orders
""")
def csv_export_readback(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export")
    k, priority = F.col("o_orderkey") % 7, F.col("o_orderpriority")
    note = (F.when(k == 0, None).when(k == 1, "").when(k == 2, F.concat(F.lit("  "), priority, F.lit(" ")))
            .when(k == 3, F.concat(F.lit('a;b"'), "o_orderstatus", F.lit('"')))
            .when(k == 4, F.concat(F.lit('\\"; '), priority)).when(k == 5, "\\N \nx").otherwise(priority))
    df = t.t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", note.alias("note"))
    write_csv(df, path)
    return read_csv(t.spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                                   "o_orderdate TIMESTAMP_NTZ, note STRING")


# ---------------------------------------------------------------- 2.2 projection

@query("project_alias_literals", "B1 B2 B3", """
SELECT *, CAST(2 AS BIGINT) AS codigo_entidad, 'ENTITY' AS descripcion, '' AS fecha_primera_intervencion,
       '0.00' AS tiempo_quirurgico_total, l_orderkey AS identificador
FROM lineitem
""")
def project_alias_literals(t: Tables) -> DataFrame:
    return t.t("lineitem").select(
        "*", F.lit(2).cast("bigint").alias("codigo_entidad"), F.lit("ENTITY").alias("descripcion"),
        F.lit("").alias("fecha_primera_intervencion"), F.lit("0.00").alias("tiempo_quirurgico_total"),
        F.col("l_orderkey").alias("identificador"))


@query("nested_field_access", "B4 D8", """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def nested_field_access(t: Tables) -> DataFrame:
    ex = op.explode_rows(nested_orders(t), "lines", "line")
    return ex.select("o_orderkey", F.col("line.l_linenumber").alias("l_linenumber"),
                     F.col("line.l_partkey").alias("l_partkey"), F.col("line.l_quantity").alias("l_quantity"))


@query("mask_members", "B5 B8", """
SELECT c_custkey AS numero_afiliado, '.' AS nom_corto, '.' AS apellidos,
       CAST(c_custkey AS VARCHAR) AS ruc, CAST(c_custkey AS VARCHAR) AS num_documento,
       coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0.0) AS acctbal,
       CAST(coalesce(CASE WHEN c_nationkey < 20 THEN c_nationkey END, 999999) AS BIGINT) AS cod_departamento
FROM customer
""")
def mask_members(t: Tables) -> DataFrame:
    c = t.t("customer").select(
        F.col("c_custkey").alias("numero_afiliado"), F.col("c_name").alias("nom_corto"),
        F.col("c_mktsegment").alias("apellidos"), F.lit(None).cast("string").alias("ruc"),
        F.lit(None).cast("string").alias("num_documento"),
        F.coalesce(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")), F.lit(0.0)).alias("acctbal"),
        F.coalesce(F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")), F.lit(999999))
        .cast("bigint").alias("cod_departamento"))
    masked = op.mask(c, constants={"nom_corto": ".", "apellidos": "."},
                     copies={"ruc": "numero_afiliado", "num_documento": "numero_afiliado"})
    return masked.select("numero_afiliado", "nom_corto", "apellidos", F.col("ruc").cast("string").alias("ruc"),
                         F.col("num_documento").cast("string").alias("num_documento"), "acctbal",
                         "cod_departamento")


@query("derived_then_filter", "B6 B7 S30", """
SELECT * FROM (
  SELECT o.o_orderkey, o.o_orderdate AS fec_ingreso, max(l.l_shipdate) AS fec_salida,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(max(l.l_shipdate) AS DATE)) AS BIGINT) AS dias_estancia
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_orderkey, o.o_orderdate) s
WHERE dias_estancia > 1
""")
def derived_then_filter(t: Tables) -> DataFrame:
    per = (t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
           .groupBy("o_orderkey", F.col("o_orderdate").alias("fec_ingreso"))
           .agg(F.max("l_shipdate").alias("fec_salida")))
    return (per.withColumn("dias_estancia", cf.days_between("fec_salida", "fec_ingreso").cast("bigint"))
            .where(F.col("dias_estancia") > 1))


# ---------------------------------------------------------------- 2.3 filters

@query("predicates_mix", "C3 C4 C6 C7 C8", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag <> 'N' AND l_quantity >= 10 AND l_discount <= 0.05 AND l_linestatus IN ('F')
  AND l_suppkey NOT IN (1, 2, 3) AND l_partkey IS NOT NULL
""")
def predicates_mix(t: Tables) -> DataFrame:
    li = t.t("lineitem")
    return (li.where((F.col("l_returnflag") != "N") & (F.col("l_quantity") >= 10)
                     & (F.col("l_discount") <= 0.05) & F.col("l_linestatus").isin("F")
                     & ~F.col("l_suppkey").isin(1, 2, 3) & F.col("l_partkey").isNotNull())
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("between_timestamp", "C5 S32", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01 00:00:00' AND TIMESTAMP '1997-08-31 00:00:00'
""")
def between_timestamp(t: Tables) -> DataFrame:
    return (t.t("orders").where(F.col("o_orderdate").between(cf.ts_ntz("1997-03-01"), cf.ts_ntz("1997-08-31")))
            .select("o_orderkey", "o_orderdate"))


def _null_when_low(c: str):
    return F.when(F.col("o_orderpriority") != "5-LOW", F.col(c))


@query("not_null_self_eq", "C9", """
SELECT o_orderkey, k FROM (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k FROM orders) s
WHERE k = k + 0
""")
def not_null_self_eq(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", _null_when_low("o_custkey").alias("k"))
    return op.require_not_null(o, "k")


@query("lexical_money_compare", "C10 S34", """
SELECT l_orderkey, l_linenumber, CAST(l_tax AS VARCHAR) AS tax_text,
       CASE WHEN CAST(l_tax AS VARCHAR) <= '0.0' THEN CAST(CAST(l_discount AS VARCHAR) AS DOUBLE)
            ELSE CAST(CAST(l_tax AS VARCHAR) AS DOUBLE) END AS copago
FROM lineitem
""")
def lexical_money_compare(t: Tables) -> DataFrame:
    li = t.t("lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").cast("string").alias("tax_text"),
                                F.col("l_discount").cast("string").alias("disc_text"))
    return li.select("l_orderkey", "l_linenumber", "tax_text",
                     cf.pick_amount("tax_text", "disc_text").alias("copago"))


@query("year_filter", "C11 S25", """
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS BIGINT) AS anio FROM orders
WHERE year(o_orderdate) IN (1997, 1999)
""")
def year_filter(t: Tables) -> DataFrame:
    return (t.t("orders").where(cf.in_year("o_orderdate", 1997, 1999))
            .select("o_orderkey", "o_orderdate", F.year("o_orderdate").cast("bigint").alias("anio")))


@query("having_threshold", "C12 E1 E16", """
SELECT o_custkey, o_orderpriority, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS cantidad
FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(DISTINCT o_orderkey) >= 2
""")
def having_threshold(t: Tables) -> DataFrame:
    return op.repeat_flag(t.t("orders"), ["o_custkey", "o_orderpriority"], "o_orderkey", 2)


@query("outer_where_inner", "C13", """
SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def outer_where_inner(t: Tables) -> DataFrame:
    c = t.t("customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return (t.t("orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
            .select("o_orderkey", "c_custkey", "c_mktsegment"))


@query("like_filter", "C14", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'
""")
def like_filter(t: Tables) -> DataFrame:
    return t.t("part").where(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


# ---------------------------------------------------------------- 2.4 joins

@query("left_join_single", "D1", """
SELECT c.c_custkey, o.o_orderkey
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o
  ON c.c_custkey = o.o_custkey
""")
def left_join_single(t: Tables) -> DataFrame:
    o = t.t("orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderkey")
    return (t.t("customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "o_orderkey"))


@query("left_join_composite", "D2", """
WITH a AS (SELECT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
                  CAST(count(*) AS BIGINT) AS n_orders
           FROM orders GROUP BY 1, 2),
     b AS (SELECT o.o_custkey AS custkey, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS mes,
                  round(sum(l.l_quantity), 4) AS qty
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
SELECT a.custkey, a.mes, a.n_orders, b.qty FROM a LEFT JOIN b ON a.custkey = b.custkey AND a.mes = b.mes
""")
def left_join_composite(t: Tables) -> DataFrame:
    o = t.t("orders")
    a = (o.groupBy(F.col("o_custkey").alias("custkey"), _month().alias("mes"))
         .agg(F.count(F.lit(1)).alias("n_orders")))
    b = (t.t("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .groupBy(F.col("o_custkey").alias("custkey"), cf.month_start("l_shipdate").alias("mes"))
         .agg(_r4(F.sum("l_quantity")).alias("qty")))
    return a.join(b, ["custkey", "mes"], "left").select("custkey", "mes", "n_orders", "qty")


@query("left_join_residual", "D3", """
SELECT c.c_custkey, n.n_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey = 1 AND n.n_name <> 'NATION_1'
""")
def left_join_residual(t: Tables) -> DataFrame:
    n = t.t("nation").where((F.col("n_regionkey") == 1) & (F.col("n_name") != "NATION_1"))
    return (t.t("customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "n_name"))


@query("inner_join", "D4", """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l INNER JOIN part p ON l.l_partkey = p.p_partkey
""")
def inner_join(t: Tables) -> DataFrame:
    return (t.t("lineitem").join(t.t("part"), F.col("l_partkey") == F.col("p_partkey"), "inner")
            .select("l_orderkey", "l_linenumber", "p_brand"))


@query("multi_way_inner", "D5 D6", """
SELECT o.o_orderkey, l.l_linenumber, s.s_name, p.p_name
FROM orders o, lineitem l, supplier s
LEFT JOIN (SELECT * FROM part WHERE p_size > 40) p ON p.p_partkey = l.l_partkey
WHERE o.o_orderkey = l.l_orderkey AND l.l_suppkey = s.s_suppkey
""")
def multi_way_inner(t: Tables) -> DataFrame:
    p = t.t("part").where(F.col("p_size") > 40).select("p_partkey", "p_name")
    j = (t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
         .join(t.t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey"), "left"))
    return j.select("o_orderkey", "l_linenumber", "s_name", "p_name")


@query("computed_key_join", "D7 S1 S6 S7", """
SELECT o.o_orderkey, p.id_persona, lpad(CAST(o.o_custkey AS VARCHAR), 7, '0') AS pad,
       substring(p.id_persona, 4) AS stripped
FROM orders o
JOIN (SELECT 'AX-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS id_persona FROM customer) p
  ON 'AX-' || lpad(CAST(o.o_custkey AS VARCHAR), 7, '0') = p.id_persona
""")
def computed_key_join(t: Tables) -> DataFrame:
    person = t.t("customer").select(cf.prefixed(cf.pad_lot("c_custkey"), "AX-").alias("id_persona"))
    feed = t.t("orders").select("o_orderkey", cf.pad_lot("o_custkey").alias("pad"))
    j = feed.join(person, cf.prefixed("pad", "AX-") == F.col("id_persona"))
    return j.select("o_orderkey", "id_persona", "pad", cf.strip_prefix("id_persona").alias("stripped"))


@query("explode_outer_claims", "D8", """
SELECT o.o_orderkey, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(l.l_linenumber) AS BIGINT) AS n_lines
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey
""")
def explode_outer_claims(t: Tables) -> DataFrame:
    ex = op.explode_rows(nested_orders(t), "lines", "line")
    return ex.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count("line.l_linenumber").alias("n_lines"))


@query("explode_two_levels", "D9", """
SELECT o.o_orderkey, r.l_linenumber, r.kind, r.code
FROM orders o LEFT JOIN (
  SELECT l_orderkey, l_linenumber, 'part' AS kind, CAST(l_partkey AS VARCHAR) AS code FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, 'supplier' AS kind, CAST(l_suppkey AS VARCHAR) AS code FROM lineitem) r
  ON o.o_orderkey = r.l_orderkey
""")
def explode_two_levels(t: Tables) -> DataFrame:
    """order -> lines[] -> references[] (claim -> care event -> procedure shape)."""
    refs = F.array(F.struct(F.lit("part").alias("kind"), F.col("l_partkey").cast("string").alias("code")),
                   F.struct(F.lit("supplier").alias("kind"), F.col("l_suppkey").cast("string").alias("code")))
    nested = t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn(
        "lines", F.when(F.col("l_orderkey").isNotNull(), F.array(F.struct("l_linenumber", refs.alias("refs")))))
    ex = op.explode_path(nested.select("o_orderkey", "lines"), [("lines", "l"), ("l.refs", "r")])
    return ex.select("o_orderkey", F.col("l.l_linenumber").alias("l_linenumber"),
                     F.col("r.kind").alias("kind"), F.col("r.code").alias("code"))


@query("explode_filter_inner", "D10", """
SELECT o.o_orderkey, l.l_linenumber, l.l_linestatus
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE l.l_linestatus = 'F'
""")
def explode_filter_inner(t: Tables) -> DataFrame:
    n = nested_orders(t).withColumn("lines", op.keep_elements("lines", lambda x: x["l_linestatus"] == "F"))
    ex = op.explode_rows(n, "lines", "line", outer=False)
    return ex.select("o_orderkey", F.col("line.l_linenumber").alias("l_linenumber"),
                     F.col("line.l_linestatus").alias("l_linestatus"))


@query("semi_join", "D11", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def semi_join(t: Tables) -> DataFrame:
    keys = t.t("lineitem").where(F.col("l_returnflag") == "R")
    return op.semi_in(t.t("orders"), "o_orderkey", keys, "l_orderkey").select("o_orderkey", "o_custkey")


@query("null_aware_anti", "D12", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k FROM orders)
SELECT 'plain' AS label, o_orderkey, k FROM o
 WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL
SELECT 'with_null' AS label, o_orderkey, k FROM o
 WHERE k NOT IN (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END FROM customer)
UNION ALL
SELECT 'empty' AS label, o_orderkey, k FROM o
 WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 1e15)
""")
def null_aware_anti(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", _null_when_low("o_custkey").alias("k"))
    c = t.t("customer")
    plain = op.not_in(o, "k", c.where(F.col("c_mktsegment") == "BUILDING"), "c_custkey", written=False)
    with_null = op.not_in(o, "k", c.select(F.when(F.col("c_mktsegment") != "BUILDING",
                                                  F.col("c_custkey")).alias("c_custkey")), "c_custkey",
                          written=False)
    empty = op.not_in(o, "k", c.where(F.col("c_acctbal") > 1e15), "c_custkey", written=False)
    return op.union_all(*[d.select(F.lit(lbl).alias("label"), "o_orderkey", "k")
                          for lbl, d in (("plain", plain), ("with_null", with_null), ("empty", empty))])


@query("priority_classification", "D13 H2 E12", """
WITH c1 AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'),
     c5 AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_totalprice > 300000
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c1)),
     c4 AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F'
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c1)
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c5)),
     c2 AS (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R'
              AND l_orderkey NOT IN (SELECT o_orderkey FROM c1)
              AND l_orderkey NOT IN (SELECT o_orderkey FROM c5)
              AND l_orderkey NOT IN (SELECT o_orderkey FROM c4)),
     c6 AS (SELECT DISTINCT o_orderkey FROM orders
              WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c1)
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c5)
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c4)
              AND o_orderkey NOT IN (SELECT o_orderkey FROM c2))
SELECT o_orderkey, '1' AS tipo FROM c1 UNION ALL SELECT o_orderkey, '5' FROM c5
UNION ALL SELECT o_orderkey, '4' FROM c4 UNION ALL SELECT o_orderkey, '2' FROM c2
UNION ALL SELECT o_orderkey, '6' FROM c6
""")
def priority_classification(t: Tables) -> DataFrame:
    o = t.t("orders")
    cands = [
        ("1", o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey").distinct()),
        ("5", o.where(F.col("o_totalprice") > 300000).select("o_orderkey").distinct()),
        ("4", o.where(F.col("o_orderstatus") == "F").select("o_orderkey").distinct()),
        ("2", t.t("lineitem").where(F.col("l_returnflag") == "R")
         .select(F.col("l_orderkey").alias("o_orderkey")).distinct()),
        ("6", o.select("o_orderkey").distinct()),
    ]
    return op.classify_by_priority(cands, "o_orderkey").select("o_orderkey", "tipo")


@query("anti_with_nested_semi", "D14", """
SELECT o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem
                         WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 5))
""")
def anti_with_nested_semi(t: Tables) -> DataFrame:
    sup = t.t("supplier").where(F.col("s_nationkey") == 5)
    inner = op.semi_in(t.t("lineitem"), "l_suppkey", sup, "s_suppkey")
    return op.not_in(t.t("orders"), "o_orderkey", inner, "l_orderkey").select("o_orderkey")


@query("join_hit_choice", "D15", """
SELECT c.c_custkey,
       CASE WHEN c.c_custkey = x.o_custkey THEN CAST(x.last_urgent AS VARCHAR) ELSE 'NONE' END AS val
FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_urgent FROM orders
                           WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) x
  ON c.c_custkey = x.o_custkey
""")
def join_hit_choice(t: Tables) -> DataFrame:
    x = (t.t("orders").where(F.col("o_orderpriority") == "1-URGENT")
         .groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_urgent")))
    j = t.t("customer").join(x, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", op.join_hit("c_custkey", "o_custkey", F.col("last_urgent").cast("string"),
                                             F.lit("NONE")).alias("val"))


_PLACE_SQL = """
CASE WHEN place_raw IN ('NATION_24') THEN 'NATION_0'
     WHEN coalesce(place_raw, 'ND') IN ('', 'ND') THEN 'NO DETERMINADO' ELSE place_raw END
"""


@query("dimension_default", "D16 S13 S14", f"""
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
              WHEN c_mktsegment = 'HOUSEHOLD' THEN ''
              ELSE 'NATION_' || CAST(c_nationkey + 3 AS VARCHAR) END AS place_raw
  FROM customer),
p AS (SELECT c_custkey, {_PLACE_SQL} AS place FROM c)
SELECT p.c_custkey, p.place, CAST(coalesce(n.n_nationkey, 999999) AS BIGINT) AS cod_departamento
FROM p LEFT JOIN nation n ON n.n_name = p.place
""")
def dimension_default(t: Tables) -> DataFrame:
    c = t.t("customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(None).cast("string"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(""))
        .otherwise(F.concat(F.lit("NATION_"), (F.col("c_nationkey") + 3).cast("string"))).alias("place_raw"))
    p = c.select("c_custkey", cf.normalise_place("place_raw", ["NATION_24"], "NATION_0").alias("place"))
    out = op.lookup_code(p, t.t("nation"), "place", "n_name", "n_nationkey", "cod_departamento", 999999)
    return out.select("c_custkey", "place", F.col("cod_departamento").cast("bigint").alias("cod_departamento"))


@query("shared_subplan", "D17", """
WITH a AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 4) AS total
           FROM orders GROUP BY o_custkey)
SELECT 'many' AS label, o_custkey, n FROM a WHERE n >= 12
UNION ALL SELECT 'big' AS label, o_custkey, n FROM a WHERE total > 2500000
UNION ALL SELECT 'one' AS label, o_custkey, n FROM a WHERE n = 1
""")
def shared_subplan(t: Tables) -> DataFrame:
    a = (t.t("orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("n"), _r4(F.sum("o_totalprice")).alias("total")))
    # Three consumers of one aggregate; written once, because each would prune
    # the scan differently and so compute its own.
    a = stage(a, "customer_totals")
    return op.union_all(a.where(F.col("n") >= 12).select(F.lit("many").alias("label"), "o_custkey", "n"),
                        a.where(F.col("total") > 2500000).select(F.lit("big").alias("label"), "o_custkey", "n"),
                        a.where(F.col("n") == 1).select(F.lit("one").alias("label"), "o_custkey", "n"))


@query("dead_join_free", "D18 E13", """
SELECT DISTINCT c.c_custkey, c.c_mktsegment, CAST(count(o.o_orderkey) AS BIGINT) AS n_orders
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_name = 'NATION_' || CAST(c.c_nationkey AS VARCHAR)
GROUP BY c.c_custkey, c.c_mktsegment
""")
def dead_join_free(t: Tables) -> DataFrame:
    # The nation join of the SQL form adds no column and (names are unique)
    # no row, so it is left out; the DISTINCT over the GROUP BY is a no-op.
    return (t.t("customer").join(t.t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
            .groupBy("c_custkey", "c_mktsegment").agg(F.count("o_orderkey").alias("n_orders")))


# ---------------------------------------------------------------- 2.5 aggregation

@query("group_ordinals_wide", "E2", """
SELECT o_custkey, o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS anio,
       substr(o_orderpriority, 1, 1) AS prio, CAST(2 AS BIGINT) AS codigo_entidad,
       CAST(count(*) AS BIGINT) AS n, min(o_orderdate) AS primera
FROM orders GROUP BY 1, 2, 3, 4, 5
""")
def group_ordinals_wide(t: Tables) -> DataFrame:
    g = (t.t("orders").groupBy("o_custkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("anio"),
                               F.substring("o_orderpriority", 1, 1).alias("prio"))
         .agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("primera")))
    return g.select("o_custkey", "o_orderstatus", "anio", "prio",
                    F.lit(2).cast("bigint").alias("codigo_entidad"), "n", "primera")


@query("count_distinct_group", "E3", """
SELECT l_suppkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n_orders FROM lineitem GROUP BY l_suppkey
""")
def count_distinct_group(t: Tables) -> DataFrame:
    return op.count_distinct_by(t.t("lineitem"), ["l_suppkey"], "l_orderkey", "n_orders")


@query("count_distinct_global", "E4", """
SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_members FROM orders
""")
def count_distinct_global(t: Tables) -> DataFrame:
    return t.t("orders").agg(F.count_distinct("o_custkey").alias("n_members"))


@query("min_max_dates", "E5", """
SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
""")
def min_max_dates(t: Tables) -> DataFrame:
    return t.t("lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"),
                                                     F.max("l_shipdate").alias("last_ship"))


@query("sum_and_differences", "E6 E7 E8", """
WITH x AS (SELECT l_suppkey, l_extendedprice AS a,
                  CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice * l_tax END AS b FROM lineitem)
SELECT l_suppkey, round(sum(a), 4) AS total_a, round(sum(a - b), 4) AS sum_of_diff,
       round(sum(a) - sum(b), 4) AS diff_of_sums
FROM x GROUP BY l_suppkey
""")
def sum_and_differences(t: Tables) -> DataFrame:
    x = t.t("lineitem").select("l_suppkey", F.col("l_extendedprice").alias("a"),
                               F.when(F.col("l_tax") != 0, F.col("l_extendedprice") * F.col("l_tax")).alias("b"))
    return x.groupBy("l_suppkey").agg(_r4(F.sum("a")).alias("total_a"),
                                      _r4(F.sum(F.col("a") - F.col("b"))).alias("sum_of_diff"),
                                      _r4(F.sum("a") - F.sum("b")).alias("diff_of_sums"))


@query("string_list", "E9", """
SELECT o.o_custkey, string_agg(p.p_brand, ',' ORDER BY p.p_brand) AS brands
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_custkey
""")
def string_list(t: Tables) -> DataFrame:
    j = (t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
         .join(t.t("part"), F.col("l_partkey") == F.col("p_partkey")))
    return op.ordered_list(j, ["o_custkey"], "p_brand", ",", "brands")


@query("aligned_lists", "E10", """
WITH f AS (SELECT o.o_custkey, p.p_brand, min(o.o_orderdate) AS first_date
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
           WHERE p.p_type IN ('PROMO', 'LARGE') GROUP BY 1, 2)
SELECT o_custkey,
       string_agg(p_brand, ',' ORDER BY p_brand NULLS FIRST, CAST(first_date AS VARCHAR) NULLS FIRST) AS brand_list,
       string_agg(CAST(first_date AS VARCHAR), ',' ORDER BY p_brand NULLS FIRST, CAST(first_date AS VARCHAR) NULLS FIRST) AS date_list
FROM f GROUP BY o_custkey
""")
def aligned_lists(t: Tables) -> DataFrame:
    j = (t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
         .join(t.t("part").where(F.col("p_type").isin("PROMO", "LARGE")), F.col("l_partkey") == F.col("p_partkey")))
    f = j.groupBy("o_custkey", "p_brand").agg(F.min("o_orderdate").alias("first_date"))
    return op.aligned_lists(f, ["o_custkey"], "p_brand", "first_date", ",", "brand_list", "date_list")


@query("first_affiliation", "E11", """
WITH x AS (SELECT o_custkey,
                  CASE WHEN o_orderpriority <> '5-LOW' THEN TIMESTAMP '1997-01-01 00:00:00' END AS joined,
                  o_orderdate FROM orders)
SELECT o_custkey, joined,
       CASE WHEN joined > min(o_orderdate) THEN min(o_orderdate) ELSE joined END AS periodo_afiliacion
FROM x GROUP BY o_custkey, joined
""")
def first_affiliation(t: Tables) -> DataFrame:
    x = t.t("orders").select("o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", cf.ts_ntz("1997-01-01"))
                             .alias("joined"), "o_orderdate")
    g = x.groupBy("o_custkey", "joined").agg(F.min("o_orderdate").alias("m"))
    return g.select("o_custkey", "joined", cf.earlier_of("joined", "m").alias("periodo_afiliacion"))


@query("distinct_rows", "E12", """
SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem
""")
def distinct_rows(t: Tables) -> DataFrame:
    return t.t("lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("flag_join_back", "E14", """
SELECT o.o_orderkey, f.flag_emergencia, CASE WHEN f.flag_emergencia = 'E' THEN '1' ELSE '8' END AS via_ingreso
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, 'E' AS flag_emergencia FROM lineitem WHERE l_returnflag = 'R') f
  ON o.o_orderkey = f.l_orderkey
""")
def flag_join_back(t: Tables) -> DataFrame:
    keys = t.t("lineitem").where(F.col("l_returnflag") == "R")
    j = op.flag_from_keys(t.t("orders"), keys, "o_orderkey", "l_orderkey", "flag_emergencia", "E")
    return j.select("o_orderkey", "flag_emergencia",
                    F.when(F.col("flag_emergencia") == "E", "1").otherwise("8").alias("via_ingreso"))


# ---------------------------------------------------------------- 2.6 windows, 2.7 sort

@query("row_number_rank", "F1", """
SELECT k, o_orderkey, row_number() OVER (PARTITION BY k ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS r
FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k FROM orders) o
""")
def row_number_rank(t: Tables) -> DataFrame:
    # Every row is ranked, so a customer holding a large share of the orders
    # must not land in one task: the range-split ranking spreads it.
    # Orders of low priority have no key; they are one partition, as in a window.
    o = t.t("orders").select(_null_when_low("o_custkey").alias("k"), "o_orderkey", "o_orderdate")
    return op.rank_desc_split(o, ["k"], ["o_orderdate", "o_orderkey"]).select("k", "o_orderkey", "r")


@query("latest_per_key", "F2", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS r
  FROM orders) s WHERE r = 1
""")
def latest_per_key(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return op.latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate")


@query("sorted_limit", "G1 G2", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10
""")
def sorted_limit(t: Tables) -> DataFrame:
    # A top-k report: the limit is the feature. Spark plans TakeOrderedAndProject
    # (per-partition top 10, then a merge of at most 10 x partitions rows).
    return (t.t("orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc()).limit(10))


# ---------------------------------------------------------------- 2.9 scalar functions

_KEY6_SQL = ("'RS-' || o.o_orderstatus || '-' || CAST(o.o_custkey AS VARCHAR) || '-' || strftime(o.o_orderdate, '%y')"
             " || '-' || CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)")


def _key6(t: Tables) -> DataFrame:
    j = t.t("orders").join(t.t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("l_orderkey", "l_linenumber",
                    cf.claim_key("o_orderstatus", "o_custkey", F.date_format("o_orderdate", "yy"),
                                 "o_orderkey", "l_linenumber").alias("id_pre_liquidacion"))


@query("claim_key_build", "S2", f"""
SELECT l.l_orderkey, l.l_linenumber, {_KEY6_SQL} AS id_pre_liquidacion
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def claim_key_build(t: Tables) -> DataFrame:
    return _key6(t)


@query("claim_key_truncate", "S3", f"""
SELECT DISTINCT
  split_part(k, '-', 1) || '-' || split_part(k, '-', 2) || '-' || split_part(k, '-', 3) || '-' ||
  split_part(k, '-', 4) || '-' || split_part(k, '-', 5) AS id_siniestro
FROM (SELECT {_KEY6_SQL} AS k FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey) s
""")
def claim_key_truncate(t: Tables) -> DataFrame:
    return _key6(t).select(cf.truncate_key("id_pre_liquidacion", 5).alias("id_siniestro")).distinct()


@query("split_first", "S4", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word FROM part
""")
def split_first(t: Tables) -> DataFrame:
    return t.t("part").select("p_partkey", cf.first_token("p_name", " ").alias("first_word"))


@query("substr_zero", "S5 S19", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS ym,
       substr(strftime(o_orderdate, '%Y%m'), 1, 4) || '-' || substr(strftime(o_orderdate, '%Y%m'), 5, 2) AS ym_dash
FROM orders
""")
def substr_zero(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", cf.fmt_yyyymm("o_orderdate").alias("ym"))
    # Position 0 behaves as position 1, as in the reference's SUBSTR(s, 0, 4).
    return o.select("o_orderkey", "ym",
                    F.concat(F.substring("ym", 0, 4), F.lit("-"), F.substring("ym", 5, 2)).alias("ym_dash"))


@query("text_clean", "S8 S9 S10 S11", r"""
SELECT p_partkey,
       CASE WHEN regexp_replace(p_brand, '[^0-9]', '', 'g') = '' THEN p_brand
            ELSE regexp_replace(p_brand, '[^0-9]', '', 'g') END AS code_brand,
       CASE WHEN regexp_replace(p_type, '[^0-9]', '', 'g') = '' THEN p_type
            ELSE regexp_replace(p_type, '[^0-9]', '', 'g') END AS code_type,
       regexp_replace(chr(9) || ' ' || p_type || ' ' || chr(10), '^\s+|\s+$', '', 'g') AS des_trimmed,
       replace(p_name || '''', '''', '') AS name_unquoted
FROM part
""")
def text_clean(t: Tables) -> DataFrame:
    p = t.t("part")
    return p.select("p_partkey", cf.digits_or_raw("p_brand").alias("code_brand"),
                    cf.digits_or_raw("p_type").alias("code_type"),
                    cf.trim_ws(F.concat(F.lit("\t "), F.col("p_type"), F.lit(" \n"))).alias("des_trimmed"),
                    cf.remove_char(F.concat(F.col("p_name"), F.lit("'")), "'").alias("name_unquoted"))


@query("recode_case", "S12 S15", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'M' WHEN o_orderstatus = 'O' THEN 'F' ELSE 'I' END AS sexo,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'NG' ELSE 'G' END AS tipo_afiliacion
FROM orders
""")
def recode_case(t: Tables) -> DataFrame:
    return t.t("orders").select(
        "o_orderkey", cf.recode("o_orderstatus", {"F": "M", "O": "F"}, "I").alias("sexo"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "NG").otherwise("G").alias("tipo_afiliacion"))


@query("casts_and_formats", "S16 S17 S18 S20 S24", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_text, strftime(o_orderdate, '%Y%m') AS aniomes,
       strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS fec_texto,
       CAST(o_orderdate AS DATE) AS fecha, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS fecha_hora
FROM orders
""")
def casts_and_formats(t: Tables) -> DataFrame:
    o = t.t("orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.col("o_custkey").cast("string").alias("cust_text"),
                    cf.fmt_yyyymm("o_orderdate").alias("aniomes"), cf.fmt_datetime(d).alias("fec_texto"),
                    d.alias("fecha"), d.cast("timestamp_ntz").alias("fecha_hora"))


@query("strict_and_safe_dates", "S21 S22", """
SELECT o_orderkey,
       CAST(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS strict_d,
       CAST(try_strptime(CASE WHEN o_orderpriority = '5-LOW' THEN 'not a date'
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS safe_d
FROM orders
""")
def strict_and_safe_dates(t: Tables) -> DataFrame:
    o = t.t("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("iso"))
    return o.select("o_orderkey", cf.strict_date("compact", "yyyyMMdd").alias("strict_d"),
                    cf.safe_date("iso", "yyyy-MM-dd").alias("safe_d"))


@query("month_end_fallback", "S23 S28 S29", """
WITH x AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y') || '-13-01'
              ELSE strftime(o_orderdate, '%Y-%m-') ||
                   CASE o_orderkey % 3 WHEN 0 THEN '30' WHEN 1 THEN '31' ELSE '99' END END AS date_str
  FROM orders)
SELECT o_orderkey, date_str,
       CAST(coalesce(CAST(try_strptime(date_str, '%Y-%m-%d') AS DATE),
                     last_day(CAST(try_strptime(substr(date_str, 1, 7) || '-01', '%Y-%m-%d') AS DATE))) AS TIMESTAMP)
         AS fecha_prestacion
FROM x
""")
def month_end_fallback(t: Tables) -> DataFrame:
    day = (F.when(F.col("o_orderkey") % 3 == 0, "30").when(F.col("o_orderkey") % 3 == 1, "31").otherwise("99"))
    x = t.t("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-01")))
        .otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-"), day)).alias("date_str"))
    return x.select("o_orderkey", "date_str", cf.month_end_fallback("date_str").alias("fecha_prestacion"))


@query("discharge_date", "S28 S31", """
SELECT o_orderkey,
       CASE WHEN n IS NOT NULL THEN CAST(CAST(o_orderdate AS DATE) + CAST(n AS INTEGER) AS DATE)
            ELSE CAST(o_orderdate AS DATE) END AS fec_egreso
FROM (SELECT o_orderkey, o_orderdate,
             CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 10000) AS BIGINT) END AS n FROM orders) s
""")
def discharge_date(t: Tables) -> DataFrame:
    o = t.t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"),
                             F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 10000)
                                    .cast("bigint")).alias("n"))
    return o.select("o_orderkey", cf.add_stay("d", "n").alias("fec_egreso"))


@query("amount_arithmetic", "S33", """
SELECT l_orderkey, l_linenumber,
       round(l_extendedprice - l_extendedprice * l_discount - l_extendedprice * l_tax, 4) AS monto_pagado,
       round(l_extendedprice - (l_extendedprice - l_extendedprice * l_discount - l_extendedprice * l_tax), 4) AS copago
FROM lineitem
""")
def amount_arithmetic(t: Tables) -> DataFrame:
    tot = F.col("l_extendedprice")
    paid = tot - tot * F.col("l_discount") - tot * F.col("l_tax")
    return t.t("lineitem").select("l_orderkey", "l_linenumber", _r4(paid).alias("monto_pagado"),
                                  _r4(tot - paid).alias("copago"))

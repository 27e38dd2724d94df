"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check).

Compares column names, Arrow types (after mapping equivalent string types)
and the multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pyarrow as pa

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t) or pa.types.is_string_view(t):
        return "string"
    if pa.types.is_timestamp(t):
        return f"timestamp[{t.unit}]"
    return str(t)


def _norm_val(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", repr(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return ("d", v.isoformat())
    if v is None:
        return ("null",)
    return ("v", v)


def rows_of(tbl: pa.Table) -> list[tuple]:
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    rows = [tuple(_norm_val(x) for x in r) for r in zip(*data)]
    return sorted(rows, key=repr)


def compare(spark_tbl: pa.Table, duck_tbl: pa.Table) -> list[str]:
    problems = []
    if sorted(spark_tbl.column_names) != sorted(duck_tbl.column_names):
        problems.append(f"columns {sorted(spark_tbl.column_names)} vs {sorted(duck_tbl.column_names)}")
        return problems
    for c in spark_tbl.column_names:
        a, b = _norm_type(spark_tbl.schema.field(c).type), _norm_type(duck_tbl.schema.field(c).type)
        if a != b:
            problems.append(f"type {c}: spark {a} vs duckdb {b}")
    if spark_tbl.num_rows != duck_tbl.num_rows:
        problems.append(f"rows {spark_tbl.num_rows} vs {duck_tbl.num_rows}")
        return problems
    ra, rb = rows_of(spark_tbl), rows_of(duck_tbl)
    if ra != rb:
        diff = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems

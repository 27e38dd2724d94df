"""Tables kept by month: rows of some months replaced, months read from the layout.

A table of snapshots is partitioned by a DATE column (``periodo``). Replacing a
month rewrites that partition alone: its new files are written beside the table
and moved in when all are there, so other months' files are not touched, a rerun
gives the same table, and a run that fails leaves the month as it was. Which months
there are is known from the folders, or from the catalog, without reading a row.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimweave.settings import session_conf
from claimweave.sources.sinks import _files, hadoop_path

MONTH_COL = "periodo"


def _dates(values) -> list[dt.date]:
    return sorted({v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)) for v in values})


def months(spark: SparkSession, where: str, col: str = MONTH_COL) -> list[dt.date]:
    """The months of a table (or of a path, which has a slash), from its partitions.

    A table may list a partition whose rows are gone; its folder then has no file
    and it isn't counted for a path, but is for a catalog table until replaced.
    """
    if "/" not in where:
        rows = spark.sql(f"SHOW PARTITIONS {where}").collect()
        parts = [dict(p.split("=", 1) for p in r[0].split("/")) for r in rows]
        return _dates(p[col] for p in parts if p[col] != "__HIVE_DEFAULT_PARTITION__")
    fs, at = _files(spark, where)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return _dates(n.split("=", 1)[1] for n in found if n.startswith(f"{col}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def latest_month(spark: SparkSession, where: str, bound, col: str = MONTH_COL) -> dt.date | None:
    """``MAX(periodo)`` up to ``bound``, answered by the partitions; None without one."""
    top = bound if isinstance(bound, dt.date) else dt.date.fromisoformat(str(bound))
    return max((m for m in months(spark, where, col) if m <= top), default=None)


def read_latest(spark: SparkSession, where: str, bound, col: str = MONTH_COL) -> DataFrame:
    """The rows of the latest month up to ``bound``: the scan lists and reads one month."""
    month = latest_month(spark, where, bound, col)
    df = spark.read.parquet(where) if "/" in where else spark.table(where)
    return df.where(F.lit(False)) if month is None else df.where(F.col(col) == F.lit(month))


def _of_months(df: DataFrame, every: list[dt.date], col: str) -> DataFrame:
    """``df``, which fails on a row of another month."""
    known = F.col(col).isin(every)
    error = F.raise_error(F.concat(F.lit(f"a row's {col} is not among the months replaced: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL"))))
    return df.withColumn(col, F.when(known, F.col(col)).otherwise(error.cast("date")))


def replace_months(df: DataFrame, path: str, which, col: str = MONTH_COL) -> dict[dt.date, int]:
    """Replace the months ``which`` (one or a list) of the partitioned parquet table at
    ``path`` by the rows of ``df``, all of which belong to them; rows of each month.

    A month without rows is emptied. Each month is swapped in by two renames, the
    old one back in place if the second fails.
    """
    spark, every = df.sparkSession, _dates(which if isinstance(which, (list, tuple, set)) else [which])
    new = f"{path.rstrip('/')}__months_{uuid.uuid4().hex}"
    seen = [F.count_if(F.col(col) == F.lit(m)).alias(m.isoformat()) for m in every]
    counts = Observation("months")
    fs, target = _files(spark, path)
    at = lambda p: hadoop_path(spark, p)
    try:
        _of_months(df, every, col).observe(counts, *seen).write.partitionBy(col).parquet(new)
        fs.mkdirs(target)
        for m in every:
            own = f"{col}={m.isoformat()}"
            # A name with a leading underscore is not read as part of the table.
            old = f"{path.rstrip('/')}/_old_{uuid.uuid4().hex}"
            had = fs.exists(at(f"{path}/{own}"))
            if had and not fs.rename(at(f"{path}/{own}"), at(old)):
                raise OSError(f"{path}/{own} can't be replaced")
            if fs.exists(at(f"{new}/{own}")) and not fs.rename(at(f"{new}/{own}"), at(f"{path}/{own}")):
                if had:
                    fs.rename(at(old), at(f"{path}/{own}"))
                raise OSError(f"{path}/{own} could not be written and is as before")
            if had:
                fs.delete(at(old), True)
    finally:
        fs.delete(at(new), True)
    return {m: counts.get[m.isoformat()] for m in every}


def replace_months_of_table(df: DataFrame, table: str, which, col: str = MONTH_COL) -> dict[dt.date, int]:
    """The same for a catalog table partitioned by ``col``, which is created if there
    is none: one dynamic partition overwrite; months without rows lose their partition."""
    spark, every = df.sparkSession, _dates(which if isinstance(which, (list, tuple, set)) else [which])
    counts = Observation("months")
    seen = [F.count_if(F.col(col) == F.lit(m)).alias(m.isoformat()) for m in every]
    rows = _of_months(df, every, col).observe(counts, *seen)
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").partitionBy(col).saveAsTable(table)
    else:
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    found = {m: counts.get[m.isoformat()] for m in every}
    there = months(spark, table, col)
    for m in every:
        if not found[m] and m in there:
            spark.sql(f"ALTER TABLE {table} DROP PARTITION ({col} = DATE '{m.isoformat()}')")
    return found

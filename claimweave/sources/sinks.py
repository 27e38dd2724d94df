"""Table and file sinks, plus the scratch folder used for written stages.

Written stages go below the shared folder named by ``spark.checkpoint.dir``
(visible to every executor). Where it is unset, a ``local`` master gets a
folder under /tmp; any other master is an error, since its executors would
each write to a disk of their own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimweave.settings import SHUFFLES_END, session_conf

Stager = Callable[[DataFrame, str], DataFrame]


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="claimweave-ckpt-", dir="/tmp")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_JOB: ContextVar[str | None] = ContextVar("job", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root, in that of the job
    (:func:`job_scratch`) if one runs."""
    job = _JOB.get()
    return f"{_shared_root(spark)}/claimweave/{f'{job}/' if job else ''}{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Staged tables written inside the block are removed when it ends, whether it
    fails or not. Frames that read them must have been run by then."""
    if _JOB.get():  # the outer job's folder goes as a whole
        yield
        return
    job = f"job-{uuid.uuid4().hex}"
    mark = _JOB.set(job)
    try:
        yield
    finally:
        _JOB.reset(mark)
        fs, at = _files(spark, f"{_shared_root(spark)}/claimweave/{job}")
        fs.delete(at, True)


@contextmanager
def step_scratch(spark: SparkSession) -> Iterator[Callable[[Stager], Stager]]:
    """Staged tables written inside the block are removed when it ends, so that those
    which only a step reads don't lie on disk until the job does. Yields what makes of a
    stager one whose tables stay."""
    outer = _JOB.get()
    step = f"{f'{outer}/' if outer else ''}step-{uuid.uuid4().hex}"
    mark = _JOB.set(step)

    def kept(stage: Stager) -> Stager:
        def own(df: DataFrame, name: str) -> DataFrame:
            inner = _JOB.set(outer)
            try:
                return stage(df, name)
            finally:
                _JOB.reset(inner)
        return own

    try:
        yield kept
    finally:
        _JOB.reset(mark)
        fs, at = _files(spark, f"{_shared_root(spark)}/claimweave/{step}")
        fs.delete(at, True)


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    at = hadoop_path(spark, path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a catalog table and the files it was written to."""
    if not spark.catalog.tableExists(table):
        return
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    spark.sql(f"DROP TABLE {table}")
    if described.get("Type") == "EXTERNAL":
        fs, at = _files(spark, described["Location"])
        fs.delete(at, True)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``CREATE OR REPLACE TABLE ... AS`` of a path: the rows are written beside it
    and swapped in at the end, so a failed run leaves the old ones in place."""
    spark, new, old = df.sparkSession, f"{path}__{uuid.uuid4().hex}", f"{path}__old_{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(new)
    _swap(spark, path, new, old)


def _swap(spark: SparkSession, path: str, new: str, old: str) -> None:
    """Move ``new`` to ``path``; if that fails, what was there stays."""
    at = lambda p: hadoop_path(spark, p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(old)):
        raise OSError(f"{path} can't be replaced")
    try:
        moved = fs.rename(at(new), at(path))
    except Exception:
        moved = False
    if not moved:
        if had and not fs.rename(at(old), at(path)):
            raise OSError(f"{new} can't be moved to {path}; the rows before are at {old}")
        raise OSError(f"{new} can't be moved to {path}, which is as before")
    if had:
        fs.delete(at(old), True)


def replace_table(df: DataFrame, table: str) -> None:
    """``CREATE OR REPLACE TABLE ... AS`` of a catalog table, swapped in by name at
    the end; if that fails, the old table keeps its name. A table by month is
    rewritten a month at a time instead (``months.replace_months_of_table``)."""
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    new, old = f"{table}__new_{mark}", f"{table}__old_{mark}"
    df.write.format("parquet").saveAsTable(new)
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")


#: Both directions: quotes doubled, edge white space kept, NULL apart from ''.
_CSV = {"quote": '"', "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    """``EXPORT DATA`` as sharded ``;``-CSV with a header line, overwriting.

    One file per task; no coalesce to one file (that would funnel all rows
    through a single task). Strings keep their edge white space, quotes are
    doubled, NULL is written ``\\N``.
    """
    df.write.mode("overwrite").options(sep=sep, header=header, emptyValue='""', **_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";",
             header: bool = True) -> DataFrame:
    """What :func:`write_csv` wrote, value for value; line breaks within strings too."""
    return spark.read.options(sep=sep, header=header, multiLine=True, emptyValue="", **_CSV).schema(schema).csv(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and read it back.

    Cuts the lineage of a frame that several consumers read (the exploded
    claim snapshot): it is computed once, survives the loss of executors,
    and each consumer still gets column pruning and filter pushdown. The shuffle
    files of the write are removed with its end: only the written rows stay on disk.
    """
    path = scratch_path(df.sparkSession, name)
    with session_conf(df.sparkSession, SHUFFLES_END):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

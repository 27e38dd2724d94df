"""CSV in shards of bounded size, with a manifest, that splits when it is read.

Line breaks and backslashes in strings are written as ``\\n``, ``\\r`` and ``\\\\``, so a
row is one line: files can be cut anywhere between lines, and one large shard is read
by several tasks. The manifest (``_manifest``, which readers of the folder skip) has
each shard's lines and a checksum of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from claimweave.sources.sinks import _CSV

MOST_ROWS = 1_000_000


def _escaped(c: str) -> Column:
    own = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(own, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _plain(c: str) -> Column:
    """Undone from left to right: a doubled backslash is not the start of a break."""
    parts = F.split(F.col(c), r"\\\\", -1)
    undone = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(undone, "\\")


def _strings(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, StringType)]


def _sums(spark: SparkSession, path: str) -> DataFrame:
    """(shard, lines, checksum) of the files at ``path``."""
    lines = spark.read.text(path).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("shard"), "value")
    return lines.groupBy("shard").agg(F.count(F.lit(1)).alias("lines"),
                                      F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string").alias("checksum"))


def write_csv_shards(df: DataFrame, path: str, sep: str = ";", most_rows: int = MOST_ROWS) -> None:
    """Write ``df`` as ``sep``-CSV with a header in each shard, at most ``most_rows`` rows a shard."""
    own = df.withColumns({c: _escaped(c) for c in _strings(df.schema)})
    own.write.mode("overwrite").option("maxRecordsPerFile", most_rows).options(
        sep=sep, header=True, emptyValue='""', **_CSV).csv(path)
    _sums(df.sparkSession, path).coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")


def verify_shards(spark: SparkSession, path: str) -> int:
    """The number of shards; an error that names those that are missing, new or changed."""
    schema = "shard string, lines long, checksum string"
    told = spark.read.schema(schema).json(f"{path.rstrip('/')}/_manifest").select("shard", F.struct("lines", "checksum").alias("told"))
    there = _sums(spark, path).select("shard", F.struct("lines", "checksum").alias("there"))
    both = told.join(there, "shard", "full")
    wrong = both.where(~F.col("told").eqNullSafe(F.col("there"))).select("shard").orderBy("shard").limit(20).collect()
    if wrong:
        raise ValueError(f"shards that differ from the manifest of {path}: {', '.join(r['shard'] for r in wrong)}")
    return told.count()


def read_csv_shards(spark: SparkSession, path: str, schema: StructType | str, sep: str = ";", verify: bool = True) -> DataFrame:
    """What :func:`write_csv_shards` wrote, value for value."""
    if verify:
        verify_shards(spark, path)
    df = spark.read.options(sep=sep, header=True, emptyValue="", **_CSV).schema(schema).csv(path)
    return df.withColumns({c: _plain(c) for c in _strings(df.schema)})

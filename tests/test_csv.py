"""CSV export and read-back, value for value."""

from __future__ import annotations

from claimweave.sources.sinks import read_csv, scratch_path, write_csv

VALUES = [None, "", " a ", '"', "\\", "\\N x", "a;b", "x\ny", '"";"";', '\\"; q', " ", "\t", 'a\\"b', "NULL", "é ☃"]


def test_strings_survive(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(list(enumerate(VALUES)), "i int, v string")
    write_csv(df, path)
    assert dict(map(tuple, read_csv(spark, path, "i int, v string").collect())) == dict(enumerate(VALUES))

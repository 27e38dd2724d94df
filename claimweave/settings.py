"""Session settings that hold while a frame is planned and run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows that agree on the bucket columns are joined in place also where the join
#: has further key columns.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

#: Bucketed tables are read by bucket also where no join of the plan needs it.
READ_BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}

#: Shuffle files go when the write that made them ends. Spark's own cleaning waits until
#: the driver's heap is collected, by when those of a whole job may lie on disk.
SHUFFLES_END = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """``settings`` hold inside the block, what held before does afterwards.

    Frames are planned when they run: an action has to be inside the block.
    """
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

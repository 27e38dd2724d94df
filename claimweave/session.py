"""Session construction for tests, the bench and local runs.

On a cluster the session comes from the platform; the library never sets
cluster-level options itself. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "claimweave", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CLAIMWEAVE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    extra = dict(extra or {})
    # Local sessions only: a scratch checkpoint folder unless one is passed in.
    # On a cluster the platform's session names the shared folder; this
    # function is not used there.
    extra.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="claimweave-ckpt-", dir="/tmp"))
    extra.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="claimweave-tables-", dir="/tmp"))
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

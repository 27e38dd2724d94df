"""Parquet tables by name.

Nothing is cached or collected: every ``t(name)`` is a lazy scan, so Catalyst
pushes filters and column pruning into the parquet reader per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """``Tables(spark, "/root/testdata/sf0.01").t("orders")``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._scans: dict[tuple[str, str | None], DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def t(self, name: str, schema: StructType | None = None) -> DataFrame:
        """Lazy scan of one table; the relation is resolved (file listing,
        footer) once per ``Tables`` and reused by every reference."""
        key = (name, schema.json() if schema is not None else None)
        if key not in self._scans:
            reader = self.spark.read
            if schema is not None:
                # An explicit narrow schema prunes nested fields that Catalyst
                # cannot prune through two levels of explode.
                reader = reader.schema(schema)
            self._scans[key] = reader.parquet(self.path(name))
        return self._scans[key]

    def stored_as(self, tables: dict[str, str]) -> Tables:
        """The same tables, of which some are read from catalog tables."""
        out = Tables(self.spark, self.root)
        out._scans = {(name, None): self.spark.table(table) for name, table in tables.items()}
        return out



def read_claims(spark: SparkSession, path: str, fields: tuple[list[str], list[str], list[str]]) -> DataFrame:
    """Read a nested claims table with only the (claim, event, procedure)
    fields a job uses (each job module exports its ``CLAIM_FIELDS``)."""
    from claimweave.sources.schemas import narrow_claims

    return spark.read.schema(narrow_claims(*fields)).parquet(path)

"""Readers, writers and the shared scratch folder."""

from claimweave.sources.tables import TABLES, Tables
from claimweave.sources.sinks import read_csv, scratch_path, write_csv, write_table

__all__ = ["TABLES", "Tables", "read_csv", "scratch_path", "write_csv", "write_table"]

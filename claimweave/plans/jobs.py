"""The three scripts as jobs: build -> write table -> (read back ->) export.

Each returns the DataFrame read back from what it wrote, so a caller can
check the committed result without recomputing the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.params import EncountersParams, MembersParams, ServiceLinesParams
from claimweave.plans import encounters as enc
from claimweave.plans import members as mem
from claimweave.plans import service_lines as svc
from claimweave.sources.sinks import job_scratch, write_csv, write_table


def run_members(inp: mem.MembersInputs, p: MembersParams, table_path: str | None = None) -> DataFrame:
    """Extract 1 ends in a distinct-member count returned to the client; the
    extract itself is optionally written first (the scripts' commented CTAS)."""
    if table_path is None:
        return mem.members_count(inp, p)
    with job_scratch(inp.claims.sparkSession):
        write_table(mem.members_extract(inp, p), table_path)
    ext = inp.claims.sparkSession.read.parquet(table_path)
    return ext.agg(F.count_distinct("numero_afiliado").alias("n_afiliados"))


def run_encounters(inp: enc.EncountersInputs, p: EncountersParams, table_path: str,
                   csv_path: str | None = None) -> DataFrame:
    """Extract 2: create-or-replace the encounter table (CSV export optional)."""
    with job_scratch(inp.claims.sparkSession):
        write_table(enc.encounters_extract(inp, p), table_path)
    out = inp.claims.sparkSession.read.parquet(table_path)
    if csv_path:
        write_csv(out, csv_path)
    return out


def run_service_lines(inp: svc.ServiceLinesInputs, p: ServiceLinesParams, table_path: str,
                      csv_path: str) -> DataFrame:
    """Extract 3: truncate + create-or-replace the table, then export it
    (read back from the table, as the export statement does) as ``;`` CSV."""
    with job_scratch(inp.claims.sparkSession):
        write_table(svc.service_lines_extract(inp, p), table_path)
    out = inp.claims.sparkSession.read.parquet(table_path)
    write_csv(out, csv_path)
    return out

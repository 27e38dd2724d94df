"""``python -m claimweave.plans.run_job JOB INPUTS.json --table T [--csv PATH] [--as-of DATE] [--monthly]``

Runs one extract from stored tables: loads its inputs, creates or replaces the
catalog table and exports it as ``;`` CSV if asked. ``INPUTS.json`` maps input
names (the fields of the job's ``*Inputs``) to table names or parquet paths;
feeds are ``{"feeds": {"M": {"header": ..., "invoice": ..., ...}}}``. Claims are
read with the narrow nested schema of the job.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.params import EncountersParams, MembersParams, ServiceLinesParams
from claimweave.plans import encounters as enc
from claimweave.plans import members as mem
from claimweave.plans import service_lines as svc
from claimweave.settings import CO_LOCATED, session_conf
from claimweave.sources.months import MONTH_COL, replace_months_of_table
from claimweave.sources.sinks import job_scratch, replace_table, write_csv
from claimweave.sources.tables import read_claims

#: Job: its inputs, default parameters, the claim fields it reads and the extract.
JOBS = {
    "members": (mem.MembersInputs, MembersParams, mem.CLAIM_FIELDS, mem.members_extract),
    "encounters": (enc.EncountersInputs, EncountersParams, enc.CLAIM_FIELDS, enc.encounters_extract),
    "service_lines": (svc.ServiceLinesInputs, ServiceLinesParams, svc.CLAIM_FIELDS, svc.service_lines_extract),
}


def load(spark: SparkSession, where: str) -> DataFrame:
    """A parquet path (with a slash) or a catalog table."""
    return spark.read.parquet(where) if "/" in where else spark.table(where)


def load_inputs(spark: SparkSession, job: str, where: dict):
    """The job's inputs from table names and paths."""
    kind, _, fields, _ = JOBS[job]
    own = {name: load(spark, at) for name, at in where.items() if name not in ("claims", "feeds")}
    claims = where["claims"]
    own["claims"] = read_claims(spark, claims, fields) if "/" in claims else spark.table(claims)
    if "feeds" in where:
        own["feeds"] = {feed: enc.FeedTables(**{n: load(spark, at) for n, at in tables.items()})
                        for feed, tables in where["feeds"].items()}
    return kind(**own)


def run(spark: SparkSession, job: str, where: dict, table: str, csv: str | None = None, params=None,
        monthly: bool = False) -> DataFrame:
    """Build, create or replace ``table``, export; returns the table. With ``monthly`` the
    table keeps a month for each run and only that of ``as_of`` is replaced and returned."""
    _, defaults, _, extract = JOBS[job]
    p = params or defaults()
    # Feeds stored by batch (``sources.feed_store``) are joined in place.
    with session_conf(spark, CO_LOCATED), job_scratch(spark):
        rows = extract(load_inputs(spark, job, where), p)
        if monthly:
            month = p.as_of.replace(day=1)
            replace_months_of_table(rows.withColumn(MONTH_COL, F.lit(month)), table, month)
        else:
            replace_table(rows, table)
    out = spark.table(table)
    if monthly:
        out = out.where(F.col(MONTH_COL) == F.lit(month)).drop(MONTH_COL)
    if csv:
        write_csv(out, csv)
    return out


def main(argv: list[str] | None = None) -> None:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("job", choices=sorted(JOBS))
    a.add_argument("inputs")
    a.add_argument("--table", required=True)
    a.add_argument("--csv")
    a.add_argument("--as-of", type=dt.date.fromisoformat)
    a.add_argument("--monthly", action="store_true")
    args = a.parse_args(argv)
    params = JOBS[args.job][1]()
    if args.as_of and hasattr(params, "as_of"):
        params = replace(params, as_of=args.as_of)
    with open(args.inputs) as f:
        run(SparkSession.builder.getOrCreate(), args.job, json.load(f), args.table, args.csv, params, args.monthly)


if __name__ == "__main__":
    main()

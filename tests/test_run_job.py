"""Jobs from stored tables: load, replace the catalog table, export."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from claimweave.plans import run_job
from claimweave.plans.extract_queries import ENCOUNTERS, SERVICE_LINES
from claimweave.sources import standin
from claimweave.sources.sinks import read_csv, replace_table, scratch_path, write_table
from claimweave.sources.tables import Tables
from fixtures import SF_SMALL


def stored(spark, inputs) -> dict:
    """The inputs written as parquet, claims partitioned by snapshot."""
    root, out = scratch_path(spark, "inputs"), {}
    for name, df in vars(inputs).items():
        if name == "feeds":
            out["feeds"] = {f: {n: put(d, f"{root}/{f}_{n}") for n, d in vars(t).items() if d is not None} for f, t in df.items()}
        elif df is not None:
            out[name] = put(df, f"{root}/{name}", ["periodo"] if name == "claims" else [])
    return out


def put(df, path, by=()):
    df.write.partitionBy(*by).parquet(path)
    return path


@pytest.mark.parametrize("job", ["encounters", "service_lines"])
def test_job_from_paths(spark, job):
    make, params = {"encounters": (standin.encounters_inputs, ENCOUNTERS),
                    "service_lines": (standin.service_lines_inputs, SERVICE_LINES)}[job]
    inputs = make(Tables(spark, SF_SMALL))
    where, table, csv = stored(spark, inputs), f"job_{uuid.uuid4().hex[:8]}", scratch_path(spark, "job_csv")
    got = run_job.run(spark, job, where, table, csv, params)
    want = run_job.JOBS[job][3](inputs, params)
    assert got.count() == want.count() > 0
    same = [F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in got.dtypes]
    assert got.select(*same).exceptAll(want.select(*same)).count() == 0
    assert read_csv(spark, csv, got.schema).exceptAll(got).count() == 0
    plan = run_job.load_inputs(spark, job, where).claims.where(F.col("periodo") == F.lit(standin.SNAPSHOT)).select(
        "id_siniestro")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodo" in plan and "ReadSchema: struct<id_siniestro:string>" in plan
    spark.sql(f"DROP TABLE {table}")


def broken(spark):
    return spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_failed_run_leaves_the_table(spark):
    table = f"kept_{uuid.uuid4().hex[:8]}"
    replace_table(spark.range(3), table)
    replace_table(spark.range(7), table)
    with pytest.raises(Exception, match="broken"):
        replace_table(broken(spark), table)
    assert spark.table(table).count() == 7
    spark.sql(f"DROP TABLE {table}")


def test_a_failed_run_leaves_the_path(spark):
    path = scratch_path(spark, "kept")
    write_table(spark.range(3), path)
    write_table(spark.range(7), path)
    with pytest.raises(Exception, match="broken"):
        write_table(broken(spark), path)
    assert spark.read.parquet(path).count() == 7

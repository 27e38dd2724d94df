"""The corpus pipeline: documents in, a mixture out.

Each stage takes all documents its predecessor kept and returns the columns of
``documents``; the last returns them with ``taken``, the words that the mixture
takes of each document. Stages see nulls, empty tables, repeated rows and extra
columns as their operators define; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import decontaminate, language, mixing, simhash, templates
from claimweave.llm.textbatch import bound_batches
from claimweave.sources.sinks import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected if its main language has less of its words.
LEAST_MAIN_SHARE = 0.4
#: Shingle length and bit distance of near copies.
SHINGLE, BITS = 3, 3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; those without a letter or such a language go."""
    bound_batches(spark)
    model = language.train(docs)
    found = docs.select(*COLUMNS, model.column(F.col("text")).alias("found"))
    kept = (F.col("found.lang") != language.UNDETERMINED) & (F.col("found.score") >= LEAST_MAIN_SHARE)
    return found.filter(kept).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs (it stays in its first
    document); those of which nothing is left go."""
    bound_batches(spark)
    drop = stage(templates.dropped_lines(docs).withColumnRenamed("doc_id", "with_lines"), "dropped_lines")
    # The same join at every size: what is dropped grows with the documents.
    met = docs.select(*COLUMNS).join(drop.hint("merge"), F.col("doc_id") == F.col("with_lines"), "left")
    text = templates.without(F.col("text"), F.col("lines"))
    new = met.select("doc_id", text.alias("text"), "lang", "source", F.when(
        F.col("lines").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars"), "lines")
    return new.filter(F.col("lines").isNull() | F.col("text").rlike(r"[^\s]")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.
    Rows without an id are kept; of rows that repeat one and its text, one stays."""
    bound_batches(spark)
    found = stage(simhash.near_duplicates(docs, shingle=SHINGLE, bits=BITS), "near_copies")
    copies = stage(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("copy")).distinct(), "copies")
    again = stage(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
                  .select(F.col("doc_id").alias("again")), "repeated_ids")
    docs = docs.select(*COLUMNS).join(copies, F.col("doc_id") == F.col("copy"), "left_anti")
    once = docs.join(again, F.col("doc_id") == F.col("again"), "left_anti")
    repeated = docs.join(again, F.col("doc_id") == F.col("again"), "left_semi").dropDuplicates(["doc_id", "text"])
    return once.union(repeated)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    bound_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs.select(*COLUMNS), benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with the words it takes of each."""
    measured = mixing.measure(docs.select(*COLUMNS))
    plan = mixing.plan(stage(measured.select("size", "source", "place"), "measured"))
    return plan.apply(measured).filter("taken > 0").select("row.*", "taken")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("mixing sources to target weights", mix_sources),
]
#: Language inference, templates and alignment are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

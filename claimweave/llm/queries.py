"""The registered queries: each applies one operator, with the parameters it
would run with, to its whole table and derives the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import (decontaminate, embeddings, language, mixing, negatives, neural_lm, quality, secrets, simhash,
                            templates, toxicity, warc, whitening)
from claimweave.llm.folds import held_out, labelled
from claimweave.llm.textbatch import bound_batches
from claimweave.sources.sinks import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = secrets.tokens_of(docs)
    found = secrets.scan(docs, secrets.train(secrets.samples(docs, tokens)), tokens=tokens)
    sizes = [F.size(F.col("fixed")[k]).cast("long").alias(f"n_{name}") for k, name in enumerate(("assign", "access", "hex"))]
    base = F.flatten("fixed")
    return found.select("row.doc_id", *sizes, F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.concat(base, "markov")).alias("spans"))


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(labelled(docs, labels, "toxic", ["text"], ~held_out("doc_id", 5, 0)))
    scored = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), model.column(F.col("text")).alias("found"))
    return scored.select("doc_id", "held_out", "found.score", (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
                         F.size("found.passages").alias("n_passages"))


@_query
def op4_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = warc.archive_and_index(_table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position")


_PART = "('0x' || substr(hex, {at}, 5))::INTEGER"
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({part} >> {shift}) & 31), 1)"
_BASE32 = " || ".join(_DIGIT.format(part=_PART.format(at=at), shift=shift)
                      for at in range(1, 41, 5) for shift in (15, 10, 5, 0))
ORACLE_SQL["op4_warc_index_merge"] = f"""
WITH page AS (
    SELECT page_id, coalesce(html, '') AS payload, upper(sha1(coalesce(html, ''))) AS hex,
           regexp_replace(regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '') AS rest
    FROM pages
), digested AS (
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
           array_to_string(list_reverse(string_split(split_part(rest, '/', 1), '.')), ',') || ')'
               || substr(rest, length(split_part(rest, '/', 1)) + 1) AS url_key
    FROM page
), first AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digested
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       row_number() OVER (ORDER BY url_key, {warc.EPOCH} + page_id % 100000000, page_id) - 1 AS position
FROM first
"""


@_query
def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured = stage(mixing.measure(docs).withColumn("row", F.struct("row.doc_id")), "measured")
    mixed = mixing.plan(measured).apply(measured)
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL["op6_mixing"] = r"""
WITH measured AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('7:' || coalesce(doc_id::VARCHAR, '')) AS place
    FROM documents
), sized AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM measured GROUP BY source
), weighted AS (
    SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
           source_size * 2.0::DOUBLE AS cap FROM sized
), stepped AS (  -- sources in the order in which rising water reaches their caps
    SELECT *, (SELECT 1.5::DOUBLE * sum(source_size) FROM sized)
                  - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open,
           row_number() OVER (ORDER BY cap / weight, source) AS step
    FROM weighted
), water AS (  -- the first that stays below its cap
    SELECT arg_min(rest / open, step) FILTER (WHERE cap >= rest / open * weight) AS level FROM stepped
), target AS (
    SELECT source, source_size, CASE WHEN level * weight > cap THEN cap ELSE level * weight END AS target
    FROM weighted, water
), epochs AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM target
), quota AS (
    SELECT *, round(target - whole * source_size)::BIGINT AS part FROM epochs
), ordered AS (
    SELECT m.doc_id, m.size, q.source_size, q.target, q.whole, q.part,
           sum(m.size) OVER (PARTITION BY m.source ORDER BY m.place, m.size ROWS UNBOUNDED PRECEDING) - m.size AS before
    FROM measured m JOIN quota q ON m.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, part - before)))::BIGINT AS taken
FROM ordered
"""


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    drop = templates.dropped_lines(docs).withColumnRenamed("doc_id", "id")
    lines = F.coalesce(F.regexp_count("text", F.lit("\n")) + 1, F.lit(0)).cast("long")
    every = docs.select("doc_id", lines.alias("n_lines")).join(drop, F.col("doc_id") == F.col("id"), "left")
    return every.select("doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("dropped_lines"))


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.train(labelled(docs, labels, "quality", ["text", "n_chars"], ~held_out("doc_id", 5, 0),
                                   most=quality.MOST_TRAINED))
    scored = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"),
                         model.column(F.col("text"), F.col("n_chars")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4, 2))
    model = language.train(docs.filter(~F.col("held_out")))
    return docs.select("doc_id", "held_out", model.column(F.col("text")).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score",
        F.col("found.languages").alias("languages"))


@_query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, scored = neural_lm.learn_and_score(docs, ~held_out("doc_id", 10, 0))
    scored = scored.withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)


ORACLE_SQL["op12_hard_negatives"] = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id
WHERE NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""


@_query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    every = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    return every.select(F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
                        F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
                        F.get(share, F.col("at")).alias("explained"),
                        F.lit(model.identity_error).cast("double").alias("identity_error"))

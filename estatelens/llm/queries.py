"""The operators as queries over the driver tables, and their SQL where there is one."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from estatelens.llm import (dac, langid, mixing, neardup, neighbours, packing, periodic,
                            quantised, rules, substring, suffixes, toxicity, whitening)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shipped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Python workers import this package too; where it is not installed, from here."""
    @functools.wraps(fn)
    def run(spark: SparkSession, *args) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return fn(spark, *args)

    return run


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = shipped(fn)
    return QUERIES[fn.__name__]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    learned = rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.judge(docs, learned, "verdict").select(
        "doc_id", *[f"verdict.{c}" for c in rules.COUNTS[:5]], "verdict.base_failed",
        "verdict.kept", "verdict.rule")


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    samples = langid.learn(docs)
    return langid.identify(docs.select("doc_id", "text"), samples, "found").select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred",
        "found.score")


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.plan(docs, "plan", carry_text=False).select(
        "doc_id", "plan.size", "plan.source_size", "plan.target", "plan.taken", "source")


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = substring.mark(documents(spark, sf_dir).select("doc_id", "text"), "m")
    return marked.select("doc_id", F.col("m.n_items").alias("n_words"), "m.n_removed",
                         F.sha2("m.kept", 256).alias("kept_sha256"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where(F.pmod("vec_id", F.lit(neighbours.EVERY)) == 0))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = suffixes.mark(documents(spark, sf_dir).select("doc_id", "text"), "m")
    return marked.select("doc_id", F.col("m.n_items").alias("n_bytes"), "m.n_removed", "m.n_spans",
                         F.sha2("m.kept", 256).alias("kept_sha256"))


@query
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read_documents(dac.write_files(documents(spark, sf_dir)))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    machine = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, machine, "score").select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return quantised.mark(vectors, "m").select("vec_id", "m.n_links", "m.component_id", "m.kept")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.looped(documents(spark, sf_dir).select("doc_id", "text"))
    lines = F.array_join(F.transform("m.runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))), "")
    return periodic.mark(docs, "m").select(
        "doc_id", "m.n_runs", "m.start", "m.length", "m.period",
        F.floor(F.expr("1000 * m.length div m.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("m.collapsed", 256).alias("collapsed_sha256"),
        "m.n_words", "m.n_dropped")


ORACLE["op4_source_mixing"] = """
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE
              + 1.0) / 281474976710656.0)
         / coalesce(greatest(0.1, 1.0 - 4.0 * (length(text) - length(translate(text, '#*$%&|<>', '')))
                                  / greatest(length(text), 1)), 1.0) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
      FROM d GROUP BY source),
w AS (SELECT *, (place % 3 + 1)::DOUBLE AS weight, (3 * source_size)::BIGINT AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER ()
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / sum(weight) OVER (ORDER BY cap / weight, place
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w),
t AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM l),
j AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
             floor(t.target + 0.5)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((budget // greatest(source_size, 1)) * size
        + greatest(0, least(size, budget % greatest(source_size, 1) - ahead)))::BIGINT AS taken, source
FROM j
"""
ORACLE["op12_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT vec_id AS id, vec_id AS component FROM embeddings
            UNION SELECT links.b, reached.component FROM reached JOIN links ON links.a = reached.id),
least AS (SELECT id, min(component) AS component_id FROM reached GROUP BY id),
counted AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.id = e.vec_id LEFT JOIN counted c ON c.id = e.vec_id
"""

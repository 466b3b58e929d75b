"""Documents to packed training sequences: each stage is one operator of ``estatelens.llm``.

All stages take null and empty texts, null ids, repeated rows and ties, texts of any length (whole
texts are read, a task holds one at a time) and tables without rows, which give tables without rows.
The first four keep the columns they are given, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from estatelens.llm import mixing, neardup, packing, rules, substring
from estatelens.llm.queries import shipped
from estatelens.session import shared_dir


def recounted(docs: DataFrame) -> DataFrame:
    """n_chars of texts that a stage has cut."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@shipped
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the fixed rules and the learned list. Null and empty texts have no words and
    go; repeated rows are judged alike; rows without doc_id have no label but are judged."""
    learned = rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.keep_good(docs, learned)


@shipped
def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest doc_id, and one row of rows that
    repeat it. Texts without words and rows without doc_id are in no class and stay."""
    return neardup.keep_one(docs)


@shipped
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that a smaller document's passages cover. Texts that lose nothing
    stay as they are, null and empty ones too; texts that lose every word go. Rows without doc_id
    lose nothing and take nothing; rows of equal doc_id do not take from each other."""
    return recounted(substring.remove(docs))


@shipped
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, or as far, as the mix takes them. A null source is a source, the last one;
    documents without words are not taken; repeated rows are drawn apart, ties by doc_id and text."""
    return recounted(mixing.mix(docs))


@shipped
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence. Null text is empty and still has its end id;
    repeated rows are packed each; a text of more than a sequence is cut, nothing else is."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", minhash_near_dedup),
          ("substring_dedup", substring_dedup), ("source_mixing", source_mixing),
          ("best_fit_packing", best_fit_packing)]

# Learned rules, tokenizers and signatures are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    home = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{i}-{name}")
        docs = spark.read.parquet(f"{home}/{i}-{name}")
    return docs

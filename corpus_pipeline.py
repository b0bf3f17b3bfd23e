"""The corpus pipeline: toxicity, line dedup, near duplicates, mixing and packing, one operator a stage.

Each stage takes the documents that its predecessor kept and returns documents again; the last returns the packed pieces.
Documents need the columns doc_id, text, lang, source and n_chars; other columns pass through. Nulls, empty texts, repeated
rows and empty tables are taken as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandwise.llm import line_dedup, mixing, ngram_join, packing, toxicity
from strandwise.llm._runtime import stored


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    score = toxicity.scored(model, F.col("text"))["score"]
    return docs.where(score < 0.5)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate in their source; n_chars follows the text."""
    out = line_dedup.line_dedup(docs, host="source").withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near duplicates."""
    return ngram_join.deduplicated(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixing(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.packing(docs)


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("ngram_join", near), ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the learned model nor the packing; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
